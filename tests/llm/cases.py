"""Small tables and brute-force counterparts shared by the operator tests."""
from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rk string, size int, key string"


def words(text, pattern=SPACED):
    return pattern.findall((text or "").translate(LOWER))


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeéñß") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows(seed=1, n=40):
    """Documents with nulls, empty and long texts, copies, near copies, repeated rows and shared passages."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    texts = [sentence(rng, rng.randint(1, 90)) for _ in range(n)]
    base = sentence(rng, 120)
    near = base.split(" ")
    near[7] = "changed"
    texts += [base, base, " ".join(near), base + " tail", "", None, "One", "one two", "A. b! C?", " \n\t ", passage + "\n" + sentence(rng, 20),
              sentence(rng, 30) + "\n" + passage, "abc " * 900, sentence(rng, 6000), "word" * 30000, "Grüße  \U0001F600 ñ  x"]
    out = [(i * 3, t) for i, t in enumerate(texts)]
    out += [(out[2][0], out[2][1])] * 2                 # repeated rows
    out += [(None, texts[0]), (None, None)]
    rng.shuffle(out)
    return out


def frame(spark, pairs, parts=3):
    full = [(d, t, "xx", "src", len(t or ""), "clash", 1, "k") for d, t in pairs]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def by_row(result):
    """Results as a sorted list of tuples, for comparing with repeated rows."""
    return sorted((tuple(r) for r in result), key=repr)
