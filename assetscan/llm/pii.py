"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans come from four patterns (email, ip, card, phone) and always stay. Beside them these are candidates:
every token with a digit or an at sign; groups of digits joined by single spaces, hyphens or slashes, with a bracketed
group or a country code before them (9 to 19 digits in all); account numbers in groups of four; a given name of
the gazetteer with the capitalised words after it; a house number next to a street word of the gazetteer. A candidate
of several tokens stands for the tokens in it. Regex, gazetteer and context labelers vote on each (for, against,
or abstain). Expectation-maximisation over the counts of vote patterns (at most 3 ** labelers rows,
whatever the corpus) estimates each labeler's reliability without gold labels and gives each
pattern its posterior. A logistic classifier on the shape of the span and its surroundings is trained on
those posteriors, over candidates counted by feature set (at most `MAX_FEATURE_SETS` of the most frequent
sets, a bounded sample of the training rows; counting and prediction cover all). Candidates it accepts that
overlap no base span are added.

Defined results. Null text: empty, no spans. Repeated rows: equal results. Null doc_id is carried.
Empty table: no rows; without candidates nothing is added. Offsets count code points, ends are exclusive.
"""
from __future__ import annotations

import bisect
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

KINDS = ("email", "ip", "card", "phone")            # as listed by the contract
ADDED_KINDS = KINDS + ("secret", "other", "iban", "name", "address")
MAX_FEATURE_SETS = 20_000
FEATURE_BITS = 11
CHUNK = "kind string, start int, end int"
SCANNED = ("doc_id long, base array<struct<kind:string,start:int,end:int>>, "
           "candidates array<struct<kind:string,start:int,end:int,votes:int,features:string>>")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_EDGE = ".,;:!?()[]{}<>\"'"
_GROUPS = re.compile(r"(?<![0-9A-Za-z.,+])(?:\+[0-9]{1,3}[ -]?)?(?:\([0-9]{1,5}\)[ -]?)?[0-9]{2,5}(?:[ /-][0-9]{2,5}){1,6}(?![0-9A-Za-z]|[.,][0-9])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_CAPITALISED = re.compile(r"(?<!\w)([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?)((?: [A-ZÀ-ÖØ-Þ]\.)?(?: (?:de|del|der|di|du|la|van|von))?(?: [A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?){1,2})(?!\w)")

# Cue words, credential prefixes, and shapes that are not personal.
CUES = frozenset("""
    email e-mail mail contact call phone tel telephone mobile fax whatsapp correo telefon telefono courriel
    card visa mastercard amex karte tarjeta carte payment ip address host login server adresse password passwd pwd
    secret token key apikey account iban ssn
""".split())
CREDENTIAL = re.compile(r"(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|xox[abp]-[A-Za-z0-9-]{10,}|(?i:password|passwd|pwd|secret|token|api_?key)[=:]\S{6,})")
NOT_PERSONAL = re.compile(r"v?[0-9]{1,3}(?:\.[0-9]{1,3}){0,2}|(?:1[0-9]|20)[0-9]{2}|[0-9]{1,4}(?:st|nd|rd|th|%|k|m|x|kg|km|cm|mm|€|\$)?|[0-9]{1,4}[/-][0-9]{1,2}[/-][0-9]{1,4}|[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?", re.I)
DIGEST = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})(?![0-9A-Za-z])", re.I)
NAME_CUES = frozenset("""
    name named nombre nom mr mrs ms dr prof herr frau señor señora monsieur madame dear sincerely regards signed by from
    author contact patient customer client
""".split())
ADDRESS_CUES = frozenset("""
    address adresse dirección direccion lives live residing resides home street located wohnhaft wohnt anschrift vive domicilio habite
    demeure ship deliver visit at
""".split())
# The gazetteer.
MAIL_HOSTS = frozenset("mail gmail yahoo outlook hotmail proton protonmail icloud gmx example localhost".split())
MAIL_ENDINGS = frozenset("com net org edu gov info de fr es it uk io eu ch at".split())
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 61 62 63 64 65 66 81 82 84 86 90 91 92".split())
IBAN_LENGTHS = dict(AT=20, BE=16, CH=21, DE=22, DK=18, ES=24, FI=18, FR=27, GB=22, IE=22, IT=27, LU=20, NL=18, NO=15, PL=28, PT=25, SE=24)
GIVEN_NAMES = frozenset("""
    Alexander Andrea Andrew Angela Anna Anthony Antonio Barbara Bernd Brian Carmen Charles Charlotte Christian Christine Christopher
    Claudia Daniel David Deborah Dennis Dominique Donald Dorothy Edward Elena Elizabeth Emily Emma Eric Fernando Francisco
    Frank Franz Fritz George Gerhard Guillaume Hannah Hans Heinrich Helen Helga Henri Ingrid Isabel Isabelle Jacques James Jason
    Javier Jean Jeffrey Jennifer Jessica Joachim John Jonathan Jorge Joseph Joshua Julia Juan Jürgen Karen Karin Katherine Kevin
    Klaus Laura Linda Lisa Louise Lucía Manuel Margaret Maria María Marie Mark Martin Mary Matthew Michael Michel Miguel Monika
    Nancy Nathalie Nicole Olivia Pablo Patricia Paul Pedro Peter Philippe Pierre Rachel Raymond Rebecca Renate Richard Robert Ryan
    Sabine Samuel Sandra Sarah Sofia Sophie Stefan Stephen Steven Susan Susanne Teresa Thérèse Thomas Timothy Ursula Uwe Walter
    William Wolfgang Yvonne
""".split())
STREET_WORDS = frozenset("""
    street st road rd avenue ave boulevard blvd lane ln drive court square terrace highway hwy
    rue place chemin allée calle avenida plaza paseo camino carrera
""".split())
STREET_ENDINGS = ("straße", "strasse", "gasse", "weg", "platz", "allee", "damm", "ufer")
_STREET = "(?i:" + "|".join(sorted(STREET_WORDS)) + ")"
_NUMBER_FIRST = re.compile(rf"(?<![\w.,])[0-9]{{1,5}}[a-z]?,? (?:{_STREET} (?:(?:de|des|du|la|le|les) ){{0,2}}[A-ZÀ-Þ]\w+|(?:[A-ZÀ-Þ]\w+ ){{1,3}}?{_STREET})(?!\w)")
_NUMBER_LAST = re.compile(rf"(?<!\w)(?:{_STREET} (?:(?:de|del|la|las|los) ){{0,2}}(?:[A-ZÀ-Þ]\w+ ){{1,3}}|[A-ZÀ-Þ][a-zß-öø-ÿ]*(?i:{'|'.join(STREET_ENDINGS)}) )[0-9]{{1,4}}[a-z]?(?![\w.,]*[0-9])")
LABELERS = ("strict_pattern", "loose_pattern", "gazetteer", "context", "not_personal", "digit_count")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four patterns, leftmost and non-overlapping per kind; failing matches are dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _MARK.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def iban_holds(token: str) -> bool:
    """Length of the country and the remainder 1 of 97."""
    plain = token.replace(" ", "")
    moved = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
    return IBAN_LENGTHS.get(plain[:2], len(plain)) == len(plain) and int(moved) % 97 == 1


def _groups(text: str):
    """Digits in groups that no single token holds."""
    for m in _GROUPS.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 19 and (" " in m[0] or "(" in m[0]):
            yield m.start(), m.end(), "groups"


def _accounts(text: str):
    for m in _IBAN.finditer(text):
        # a word after the number that looks like its last group is left out where the number holds without it
        cut = m[0].rfind(" ")
        yield m.start(), m.start() + cut if cut > 0 and not iban_holds(m[0]) and iban_holds(m[0][:cut]) else m.end(), "iban"


def _names(text: str):
    at = 0
    while m := _CAPITALISED.search(text, at):
        if m[1] in GIVEN_NAMES or m[1].split("-")[0] in GIVEN_NAMES:
            yield m.start(), m.end(), "name"
            at = m.end()
        else:
            at = m.end(1)                                     # the next word may be the given name


def _addresses(text: str):
    for pattern in (_NUMBER_LAST, _NUMBER_FIRST):     # of overlapping ones the first found stays
        for m in pattern.finditer(text):
            yield m.start(), m.end(), "address"


def _tokens(text: str):
    """Tokens with a digit or an at sign, without the punctuation around them."""
    end = 0
    for m in _MARK.finditer(text):
        if m.start() < end:
            continue
        a, b = m.start(), m.end()
        while a > end and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        end = b
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        yield a, b, "token"


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, form), ascending and without overlap: of overlapping ones the earlier form stays, then the earlier start."""
    found = list(_names(text))
    if _MARK.search(text):
        found = [*_accounts(text), *_addresses(text), *_groups(text), *found]
    taken = []
    for a, b, form in found:
        i = bisect.bisect(taken, (a, b, form))
        if (not i or taken[i - 1][1] <= a) and (i == len(taken) or b <= taken[i][0]):
            taken.insert(i, (a, b, form))
    out, i = [], 0
    for a, b, form in _tokens(text):
        while i < len(taken) and taken[i][1] <= a:
            out.append(taken[i])
            i += 1
        if i == len(taken) or b <= taken[i][0]:
            out.append((a, b, form))
    return out + taken[i:]


def _known_to_gazetteer(token: str, digits: int, at_sign: bool) -> bool:
    if at_sign:
        labels = token.lower().rpartition("@")[2].split(".")
        return labels[0] in MAIL_HOSTS or any(x in MAIL_ENDINGS for x in labels[1:])
    if token[:1] == "+":
        code = re.match(r"[0-9]{1,3}", token[1:])
        return bool(code) and any(code[0][:n] in COUNTRY_CODES for n in (1, 2))
    return digits in (15, 16) and token[0] in "3456"


def _group_votes(token: str, digits: int) -> tuple[int, int]:
    """(loose pattern, not personal) of digits in groups: a country code, a bracketed or a leading zero group marks a phone."""
    parts = re.findall(r"[0-9]+", token)
    if token[0] in "+(0" or [len(x) for x in parts] == [3, 3, 4]:
        return (1 if digits <= 15 else 0), 0
    listed = len(parts) > 4 or all(NOT_PERSONAL.fullmatch(x) for x in parts) or len({len(x) for x in parts}) == 1 and digits not in (15, 16)
    return 0, -1 if listed else 0


def vote(text: str, a: int, b: int, base: list[tuple[str, int, int]], form: str = "token") -> tuple[list[int], str, str]:
    """(votes: 1 for, -1 against, 0 abstain; kind; features)."""
    token = text[a:b]
    digits = sum("0" <= c <= "9" for c in token)
    before = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?", text[max(0, a - 40):a].lower())[-3:]
    cues = {"name": NAME_CUES, "address": ADDRESS_CUES}.get(form, CUES)
    cue = any(w in cues for w in before) or any(token.lower().startswith(c + s) for c in ("password", "pwd", "token", "secret") for s in "=:")
    kind = next((k for k, s, e in base if s < b and a < e), None)
    at_sign, credential = token.find("@") > 0, bool(CREDENTIAL.match(token))
    if form in ("name", "address"):
        failed, strict, gazetteer, count = False, 1 if kind else 0, 1, 0
        words = re.findall(r"[^\W\d_]+", token)
        loose = 1 if len(set(words)) == len(words) and min(map(len, words[1:]), default=3) >= 2 else 0
        plain = -1 if len(set(words)) < len(words) else 0
        kind = kind or form
    elif form == "iban":
        holds = iban_holds(token)
        failed = kind is None and not holds
        strict, loose, count, plain = 1 if holds or kind else -1, 0 if failed else 1, 0, -1 if failed else 0
        gazetteer = 0 if failed else 1 if token[:2] in IBAN_LENGTHS else 0
        kind = kind or "iban"
    else:
        # the patterns' own checks speak against numbers that fail them
        failed = kind is None and (digits == len(token) and 13 <= digits <= 19 or bool(_IP.fullmatch(token)))
        strict = 1 if kind else -1 if failed else 0
        gazetteer = 0 if failed else 1 if credential or _known_to_gazetteer(token, digits, at_sign) else 0
        if form == "groups":
            (loose, plain), count = _group_votes(token, digits), 0
        else:
            loose = 0 if failed else 1 if at_sign or credential or 9 <= digits <= 19 and digits >= len(token) - 6 or token.count(".") == 3 and digits >= 4 else -1 if digits <= 4 and not at_sign else 0
            plain = -1 if failed or NOT_PERSONAL.fullmatch(token) or DIGEST.search(token) and not credential else 0
            count = 0 if failed else 1 if digits >= 9 and digits >= 0.6 * len(token) else -1 if digits < 3 and not at_sign else 0
        if kind is None:
            kind = ("secret" if credential else "email" if at_sign else "ip" if token.count(".") == 3 and token.replace(".", "").isdigit()
                    else "other" if digits < 0.6 * len(token) else "card" if digits >= (16 if form == "groups" else 13) and digits <= 19 else "phone" if digits >= 9 else "other")
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "a", token))[:12]
    features = [f"shape={shape}", f"digits={min(digits, 20)}", f"len={min(len(token), 40) // 4}", f"at={at_sign}", f"cue={cue}",
                f"head={token[:1] if not token[:1].isalnum() else 'w'}", f"ratio={int(4 * digits / max(1, len(token)))}", f"dots={min(token.count('.'), 4)}", f"failed={failed}", f"digest={bool(DIGEST.search(token))}",
                f"form={form}", f"loose={form}:{loose}:{plain}"]
    return [strict, loose, gazetteer, 1 if cue else 0, plain, count], kind, "|".join(features)


def _scan_task(batches):
    return _scan(C.small_batches(batches))


def _scan(batches):
    for rows in batches:
        base_rows, cand_rows = [], []
        for value in rows.column(1):
            text = value.as_py() or ""
            base = base_spans(text)
            base_rows.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            found = []
            by_start = sorted(base, key=lambda x: x[1])
            starts = [s for _, s, _ in by_start]
            longest = max((e - s for _, s, e in base), default=0)
            for a, b, form in candidates(text):
                lo = np.searchsorted(starts, a - longest) if starts else 0
                hi = np.searchsorted(starts, b) if starts else 0
                votes, kind, features = vote(text, a, b, by_start[lo:hi], form)
                found.append({"kind": kind, "start": a, "end": b, "votes": sum((v + 1) * 3 ** i for i, v in enumerate(votes)), "features": features})
            cand_rows.append(found)
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        cand = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("votes", pa.int32()), ("features", pa.string())])
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(base_rows, pa.list_(span)), pa.array(cand_rows, pa.list_(cand))],
                                         names=["doc_id", "base", "candidates"])


def unpack_votes(code: int) -> list[int]:
    return [code // 3 ** i % 3 - 1 for i in range(len(LABELERS))]


def estimate_reliability(counts: dict[int, float], rounds: int = 60) -> tuple[dict[int, float], np.ndarray, float]:
    """EM over vote patterns: posterior of each pattern, P(vote | class) per labeler, and the prior."""
    codes = sorted(counts)
    weight = np.array([counts[c] for c in codes], float)
    votes = np.array([unpack_votes(c) for c in codes]).reshape(-1, len(LABELERS))
    total = votes.sum(axis=1)
    post = np.where(total > 0, 0.9, np.where(total < 0, 0.1, 0.5))
    for _ in range(rounds):
        prior = float((weight @ post + 1) / (weight.sum() + 2))
        table = np.ones((2, len(LABELERS), 3)) * 0.5
        for k in range(len(LABELERS)):
            for v in (-1, 0, 1):
                here = votes[:, k] == v
                table[1, k, v + 1] += weight[here] @ post[here]
                table[0, k, v + 1] += weight[here] @ (1 - post[here])
        table /= table.sum(axis=2, keepdims=True)
        ll = np.log(table)[:, np.arange(len(LABELERS))[None, :], votes + 1].sum(axis=2)
        z = math.log(prior) - math.log(1 - prior) + ll[1] - ll[0]
        post = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return dict(zip(codes, post.tolist())), table, prior


def feature_slots(features: str) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(f.encode(), digest_size=4).digest(), "little") % (1 << FEATURE_BITS) for f in features.split("|")]


def train_classifier(rows: list[tuple[str, float, float]], steps: int = 300) -> np.ndarray:
    """Logistic regression on (features, weight, mean posterior): weights per slot, the bias last."""
    w = np.zeros((1 << FEATURE_BITS) + 1)
    if not rows:
        w[-1] = -10.0
        return w
    slots = np.array([feature_slots(f) for f, _, _ in rows])
    weight = np.array([c for _, c, _ in rows], float)
    weight = np.sqrt(weight) / np.sqrt(weight).sum()
    target = np.array([p for _, _, p in rows])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[slots].sum(axis=1) + w[-1], -50, 50)))
        err = weight * (p - target)
        g = 1e-5 * w
        np.add.at(g, slots, err[:, None])
        g[-1] += err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.2 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return w


def _spans(weights):
    def run(batches):
        w, known = weights.value, {}
        for b in batches:
            cols = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for base, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                spans = [(x["kind"], x["start"], x["end"]) for x in base]
                covered = sorted((s, e) for _, s, e in spans)
                added, i, reach = [], 0, 0
                for c in found:
                    while i < len(covered) and covered[i][0] < c["end"]:
                        reach = max(reach, covered[i][1])
                        i += 1
                    if reach > c["start"]:
                        continue
                    f = c["features"]
                    if f not in known:
                        known[f] = w[feature_slots(f)].sum() + w[-1] > 0
                    if known[f]:
                        added.append((c["kind"], c["start"], c["end"]))
                order = lambda x: (ADDED_KINDS.index(x[0]), x[1], x[2])
                text = lambda xs: ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(xs, key=order))
                for k in KINDS:
                    cols[f"n_{k}"].append(sum(x[0] == k for x in spans))
                cols["base_sha256"].append(hashlib.sha256(text(spans).encode()).hexdigest())
                cols["spans"].append(text(spans + added))
            if len(known) > 1_000_000:
                known.clear()
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(x, pa.int64() if k.startswith("n_") else pa.string()) for k, x in cols.items()],
                                             names=["doc_id", *cols])

    return run


def find_personal_data(docs: DataFrame, rk: bool = False) -> DataFrame:
    """Per document: doc_id, counts of base spans, checksum of the base spans, all spans."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = C.stage_table(d.mapInArrow(_scan_task, SCANNED), "spans")
    weights = fit(scanned)
    spans = _spans(weights)
    return scanned.mapInArrow(lambda batches: spans(C.small_batches(batches)), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def fit(scanned: DataFrame):
    """Broadcast classifier weights from the scanned candidates of the whole corpus."""
    spark = scanned.sparkSession
    each = scanned.select(F.explode("candidates").alias("c")).select("c.votes", "c.features")
    patterns = {r["votes"]: float(r["count"]) for r in each.groupBy("votes").count().collect()}   # at most 3 ** 6
    post, _, _ = estimate_reliability(patterns) if patterns else ({}, None, 0.0)
    known = F.broadcast(C.local_rows(spark, list(post.items()), "votes int, p double"))
    sets = (each.groupBy("features", "votes").count().join(known, "votes").groupBy("features")
            .agg(F.sum("count").alias("n"), (F.sum(F.col("count") * F.col("p")) / F.sum("count")).alias("p"))
            .orderBy(F.desc("n"), "features").limit(MAX_FEATURE_SETS).collect())
    return spark.sparkContext.broadcast(train_classifier([(r["features"], r["n"], r["p"]) for r in sets]))


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """Documents with each span replaced by `<kind>`: all columns stay; overlapping spans become one mask."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights = fit(C.stage_table(d.mapInArrow(_scan_task, SCANNED), "spans"))
    names = docs.columns

    def run(batches):
        apply = _spans(weights)
        for b in C.small_batches(batches):
            at = b.schema.get_field_index("text")
            texts = b.column(at).to_pylist()
            hit = [i for i, t in enumerate(texts) if t]
            if hit:
                sub = pa.RecordBatch.from_arrays([pa.array(range(len(hit)), pa.int64()), pa.array([texts[i] for i in hit], pa.string())], names=["doc_id", "text"])
                for scanned in _scan([sub]):
                    for out in apply([scanned]):
                        for i, spans in zip(hit, out.column(6).to_pylist()):
                            texts[i] = mask(texts[i], spans)
            yield pa.RecordBatch.from_arrays([pa.array(texts, b.schema.field(at).type) if i == at else b.column(i) for i in range(len(names))], schema=b.schema)

    return docs.mapInArrow(run, docs.schema)


def mask(text: str, spans: str) -> str:
    out, at = [], 0
    for s, e, k in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x)):
        if s >= at:
            out += [text[at:s], f"<{k}>"]
        at = max(at, e)
    return "".join(out) + text[at:]
