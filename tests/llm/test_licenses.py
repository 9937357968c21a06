import random
import re

from assetscan.llm import licenses as L
from . import cases as K


def brute(text):
    """All matching segments: (license, first word, words) over lines, paragraphs and the whole text."""
    found = set()
    for unit in (r"[^\n]+", r"(?:(?!\n\n)[\s\S])+", r"[\s\S]+"):
        for m in re.finditer(unit, text or ""):
            have = L.bigrams(L.normalise(m[0]))
            best = None
            for name, t in sorted(L.TEMPLATES.items()):
                b = L.bigrams(L.normalise(t))
                dice = 2 * len(have & b) / (len(have) + len(b)) if have else 0
                if dice >= L.THRESHOLD and (best is None or dice > best[0]):
                    best = (dice, name)
            if best:
                found.add((best[1], len(K.words(text[:m.start()], K.ALNUM)), len(K.words(m[0], K.ALNUM))))
    return found


def test_matches_every_template_comparison(spark):
    mit = L.TEMPLATES["MIT"]
    docs = [(i, t) for i, (_, t) in enumerate(K.rows(n=10))]
    docs += [(200, "Intro words.\nLicenced under the Apache License, version 2.0!\nMore words"), (201, mit), (202, mit.replace("Software", "Work", 1)),
             (203, "Copyright 2020 Some One\n\n" + mit), (204, "released under the mit licence"), (205, "license"), (206, mit[:200]),
             (207, "x y\n\nThis is free and unencumbered software\nreleased into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
              "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nz")]
    got = {r.doc_id: r for r in L.scan_licenses(K.frame(spark, docs)).collect()}
    for d, t in docs:
        assert {(m.license, m.start_word, m.n_words) for m in got[d].matches} == brute(t), d
    assert got[201].license == "MIT" and got[201].dice == 1.0
    assert got[204].license == "MIT-notice" and got[205].license is None and got[206].license is None


def test_size_bounds_never_drop_a_template():
    s = L.Scanner(L.TEMPLATES, 0.8)
    for text in L.TEMPLATES.values():
        words = L.normalise(text)
        for cut in range(0, len(words), 3):
            have = L.bigrams(words[cut:])
            full = max(((2 * len(have & b) / (n + len(have)), name) for n, name, b in s.templates), key=lambda x: x[0]) if have else (0, "")
            found = s.best(words[cut:])
            assert (found[0] if found else 0) == (full[0] if full[0] >= 0.8 else 0)


def test_empty_table(spark):
    assert L.scan_licenses(K.frame(spark, [])).count() == 0


def test_complete_licence_texts_are_found(spark):
    owner = "Copyright (c) 2019, The Authors. All rights reserved.\n\n"
    docs = [(i, owner * (not name.endswith("-text")) + text) for i, (name, text) in enumerate(sorted(L.TEXTS.items()))]
    got = {r.doc_id: r for r in L.scan_licenses(K.frame(spark, docs)).collect()}
    for i, name in enumerate(sorted(L.TEXTS)):
        assert got[i].license == name and got[i].dice > 0.9, name


def test_complete_texts_are_complete():
    ends = {"BSD-2-Clause": "possibility of such damage", "BSD-3-Clause": "possibility of such damage", "Zlib": "from any source distribution",
            "Unlicense": "refer to http unlicense org", "Apache-2.0-text": "limitations under the license", "GPL-2.0-text": "instead of this license",
            "GPL-3.0-text": "why not lgpl html", "MPL-2.0-text": "defined by the mozilla public license v 2 0", "CC0-1.0-text": "use of the work"}
    for name, end in ends.items():
        assert " ".join(L.normalise(L.TEMPLATES[name])).endswith(end) or end in " ".join(L.normalise(L.TEMPLATES[name])[-20:]), name


def brute_span(words, names):
    """The highest coefficient of any run of words with each of the templates."""
    best = {}
    for name in names:
        b = L.bigrams(L.normalise(L.TEMPLATES[name]))
        for i in range(len(words)):
            have = set()
            for j in range(i, len(words) - 1):
                have.add((words[j], words[j + 1]))
                best[name] = max(best.get(name, 0), 2 * len(have & b) / (len(have) + len(b)))
    return best


def test_spans_over_paragraphs_and_inside_them(spark):
    rng = random.Random(4)
    code = K.sentence(rng, 300)
    mit = L.TEMPLATES["MIT"].replace("conditions: The above", "conditions:\n\nThe above").replace("Software. THE", "Software.\n\nTHE")
    apache = L.TEMPLATES["Apache-2.0"].replace("License. You may", "License.\n\nYou may").replace("2.0 Unless", "2.0\n\nUnless")
    gpl = L.TEMPLATES["GPL-3.0"].replace("version. This", "version.\n\nThis").replace("details. You", "details.\n\nYou")
    docs = [("MIT", mit + "\n\n" + code), ("MIT", K.sentence(rng, 50) + "\n\n" + mit.replace("\n\n", " of us\n\n") + "\n" + code), ("Apache-2.0", code + "\n" + apache + "\n\n" + code),
            ("GPL-3.0", gpl + "\n\n" + code), ("MIT-notice", "This package is released under the MIT License. See the file. " + code),
            ("Apache-2.0-text", code + "\n\n" + L.TEXTS["Apache-2.0-text"] + "\n\n" + code), ("Zlib", "a b c\n\n" + L.TEXTS["Zlib"].replace("software", "Library", 1) + "\n" + code),
            ("BSD-3-Clause", code + "\n" + L.TEXTS["BSD-3-Clause"].replace("the copyright holder nor", "Some Firm nor") + "\n\n" + code), (None, code)]
    got = {r.doc_id: r for r in L.scan_licenses(K.frame(spark, [(i, t) for i, (_, t) in enumerate(docs)])).collect()}
    for i, (name, text) in enumerate(docs):
        assert got[i].license == name, (i, got[i])
        if name and i != 5:
            found = [m for m in got[i].matches if m.unit == "span" and m.license == name]
            assert len(found) == 1, (i, got[i].matches)
            words = K.words(text, K.ALNUM)[found[0].start_word:found[0].start_word + found[0].n_words]
            b, have = L.bigrams(L.normalise(L.TEMPLATES[name])), L.bigrams(L.normalise(" ".join(words)))
            assert abs(2 * len(have & b) / (len(have) + len(b)) - found[0].dice) < 1e-9
    assert got[5].dice > 0.99 and [m.license for m in got[5].matches if m.unit == "span"][0] == "Apache-2.0-text"


def test_best_span_is_the_best_of_all_runs_of_words(spark):
    rng = random.Random(8)
    names = ["MIT-notice", "CC0-1.0-notice", "MPL-2.0", "Zlib-notice"]
    docs = []
    for i in range(24):
        words = L.normalise(L.TEMPLATES[names[i % 4]])
        for _ in range(rng.randint(0, 1 + len(words) // 9)):
            words[rng.randrange(len(words))] = rng.choice(["other", "the", "noncommercial", "licence"])
        again = words[:rng.randint(0, len(words))]
        docs.append((i, " ".join(["of the licence"] * rng.randint(0, 3) + words + ["x the y"] * rng.randint(0, 3) + again + ["end"])))
    got = {r.doc_id: r for r in L.scan_licenses(K.frame(spark, docs)).collect()}
    for i, text in docs:
        for name, dice in brute_span(L.normalise(text), names).items():
            found = max((m.dice for m in got[i].matches if m.license == name), default=0)
            higher = any(m.dice >= dice - 1e-9 for m in got[i].matches)
            assert abs(found - dice) < 1e-9 if found else dice < 0.8 - 1e-9 or higher, (i, name, found, dice)


def test_repeated_licence_gives_a_span_for_each(spark):
    text = "\n\n".join(["abc " * 40 + L.TEXTS["Zlib"].replace("freely", f"freely {w}") for w in ("one", "two", "three")])
    row = L.scan_licenses(K.frame(spark, [(1, text)])).first()
    assert len([m for m in row.matches if m.unit == "span" and m.license == "Zlib"]) == 3
