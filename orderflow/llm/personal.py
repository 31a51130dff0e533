"""Personal data by weak supervision (operator 8).

Candidate spans are the base patterns' matches that pass their rule, and looser
number and address shapes that touch none of them. Labelers (pattern, gazetteer and context rules) vote for,
against or not at all on each. Votes of all documents are counted by pattern;
expectation-maximisation on those counts (their number is fixed by the number of
labelers) estimates every labeler's reliability and every vote pattern's
probability. With these as targets a final classifier (logistic regression on
span features, again on counts by feature pattern) is trained. Base spans that
pass their own rule always stay; other candidates stay when the classifier
accepts them and they touch no base span.

Texts are scanned once; counting and classifying read the written candidates.

Defined results: null text is empty; every input row gives one output row (repeated
rows too, and each counts as evidence); texts of any length are scanned whole, in
time linear in them; a vote pattern or span that comes out even is not personal
data; without candidates nothing is trained and nothing is found; an empty table
gives an empty result; other columns are not read by ``personal_data`` and kept by
``masked``.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import bounded_batches, written

BASE = ("email", "ip", "card", "phone")
#: candidates beyond the base patterns
EXTRA = ("address", "number")
KINDS = BASE + EXTRA
LABELERS = ("pattern", "gazetteer", "context_for", "context_against", "grouping")

# Gazetteers and context words. Common top-level domains, country
# calling codes, first digits of payment cards, prefixes of book numbers.
TOP_LEVEL = {"com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "dev", "app", "co", "me",
             "ai", "de", "fr", "es", "it", "uk", "eu", "us", "ch", "at", "nl", "be", "lu", "ie", "pt", "gr",
             "se", "no", "dk", "fi", "is", "pl", "cz", "sk", "hu", "ro", "bg", "si", "hr", "rs", "ua", "ru",
             "tr", "il", "in", "cn", "jp", "kr", "tw", "hk", "sg", "au", "nz", "za", "ca", "mx", "ar", "br",
             "cl", "pe", "uy", "ve"}
DIAL_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45",
              "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63",
              "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98", "212", "213",
              "216", "351", "352", "353", "354", "356", "357", "358", "359", "370", "371", "372", "375", "380",
              "381", "385", "386", "387", "420", "421", "852", "886", "966", "971", "972")
CARD_STARTS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "6")
BOOK_STARTS = ("978", "979")
FOR_WORDS = {
    "email": "mail email e-mail contact write kontakt courriel correo",
    "ip": "ip address host server login adresse",
    "card": "card visa mastercard amex credit karte carte tarjeta",
    "phone": "phone tel call mobile fax telefon portable llame",
    "address": "mail email e-mail contact write kontakt courriel correo",
    "number": "phone tel call mobile fax card account iban ssn passport telefon konto",
}
AGAINST = "version page isbn total price order item figure section doi lines rows".split()
_FOR = {k: frozenset(v.split()) for k, v in FOR_WORDS.items()}
_AGAINST = frozenset(AGAINST)

# Every base match starts where a run of its first class starts or right after
# the match before, so the look-behinds and possessive runs change no match;
# they keep the scan linear in the text.
_EMAIL = re.compile(r"([A-Za-z0-9._%+-]++)(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ADDRESS = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+"
                      r"(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}+)++", re.ASCII)
_NUMBER = re.compile(r"(?<![A-Za-z0-9.])[0-9(](?:[ ()./-]{0,2}+[0-9])++(?![A-Za-z0-9])")
_DATE = re.compile(r"(?:[12][0-9]{3}[-./][01]?[0-9][-./][0-3]?[0-9]|[0-3]?[0-9][-./][01]?[0-9][-./][12][0-9]{3})")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passes) of the base patterns' matches."""
    if "@" in text:
        for m in _EMAIL.finditer(text):
            if m.group(2):
                yield "email", m.start(), m.end(), True
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        yield "ip", m.start(), m.end(), all(len(p) <= 3 and int(p) <= 255 for p in parts)
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        yield "card", m.start(), m.end(), 13 <= len(d) <= 19 and luhn(d)
    for m in _PHONE.finditer(text):
        yield "phone", m.start(), m.end(), 9 <= len(_digits(m.group())) <= 15


def _gazetteer(kind: str, span: str, digits: str) -> int:
    """1: of a known range; -1: of none, or of another kind of number; 0: no list says."""
    if kind in ("email", "address"):
        return 1 if re.split(r"[^A-Za-z0-9-]+", span)[-1].lower() in TOP_LEVEL else -1
    if kind == "card":
        return 1 if digits.startswith(CARD_STARTS) else -1
    if kind == "phone":
        return 1 if digits.startswith(DIAL_CODES) else -1
    if kind == "ip":
        return -1 if digits.startswith("0") else 0
    book = len(digits) == 13 and digits.startswith(BOOK_STARTS)
    return -1 if book or _DATE.fullmatch(span) else 0


def _votes(text: str, kind: str, start: int, end: int, passes: bool) -> tuple[int, ...]:
    span = text[start:end]
    digits = _digits(span)
    if kind in BASE:
        pattern = 1 if passes else -1
    elif kind == "address":
        pattern = 1
    else:
        pattern = 1 if 9 <= len(digits) <= 15 or (13 <= len(digits) <= 19 and luhn(digits)) else -1
    gazetteer = _gazetteer(kind, span, digits)
    near = {w.lower() for w in _WORD.findall(text[max(0, start - 48):start])}
    near |= {w.lower() for w in _WORD.findall(text[end:end + 16])}
    groups = re.split(r"[^0-9]+", span)
    even = 0
    if kind in ("card", "phone", "number"):
        sizes = [len(g) for g in groups if g]
        even = 1 if len(sizes) in (3, 4) and min(sizes) >= 2 else (-1 if max(sizes, default=0) > 19 else 0)
    return (pattern, gazetteer, int(bool(near & _FOR[kind])), -int(bool(near & _AGAINST)), even)


def _features(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """Small fixed ranges, so that the number of patterns is fixed too."""
    span = text[start:end]
    digits = _digits(span)
    n = len(digits)

    def side(c):
        return 0 if c == "" else 1 if c.isspace() else 2 if c.isalpha() else 3
    return (KINDS.index(kind), min((end - start) // 6, 4),
            0 if n == 0 else 1 if n < 7 else 2 if n < 9 else 3 if n < 13 else 4 if n < 20 else 5,
            int(" " in span) + 2 * int("-" in span or "(" in span),
            side(text[start - 1:start]), side(text[end:end + 1]), _gazetteer(kind, span, digits) + 1)


FEATURE_SIZES = (len(KINDS), 5, 6, 4, 4, 4, 3)


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """Passing base matches, and looser shapes that touch none."""
    found = list(base_matches(text))
    solid = sorted((s, e) for _, s, e, ok in found if ok)
    starts = np.array([s for s, _ in solid], np.int64)
    reach = np.maximum.accumulate([e for _, e in solid]) if solid else np.zeros(0, np.int64)

    def free(s, e):
        k = int(np.searchsorted(starts, e))
        return k == 0 or reach[k - 1] <= s

    # what fails a base rule is no such thing, but may be a number of another kind
    found = [c for c in found if c[3]]
    for kind, pattern in (("address", _ADDRESS), ("number", _NUMBER)):
        for m in pattern.finditer(text):
            if free(m.start(), m.end()) and (
                    kind == "address" or len(_digits(m.group())) >= 7):
                found.append((kind, m.start(), m.end(), False))
    return found


def _may_hold(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Texts with a digit, an @ or a bracket: no other text has a candidate."""
    flag = np.zeros(256, bool)
    flag[list(b"0123456789@([")] = True
    return T.per_text(flag[data], off) > 0


def _scan(rows: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, str, list]]:
    raw = data.tobytes()
    for k in np.flatnonzero(_may_hold(data, off)):
        text = raw[off[k]:off[k + 1]].decode()
        found = candidates(text)
        if found:
            yield int(k), text, found


_SPANS = ("array<struct<kind:int,start:int,end:int,passes:boolean,votes:array<int>,features:array<int>>>")


def find_candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, found) of every row; found is null where there is none."""
    bounded_batches(docs.sparkSession)
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                      ("passes", pa.bool_()), ("votes", pa.list_(pa.int32())),
                      ("features", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in T.pieces(batch, "text"):
                out: list = [None] * len(rows)
                for k, text, found in _scan(rows, data, off):
                    out[k] = [{"kind": KINDS.index(c), "start": s, "end": e, "passes": ok,
                               "votes": _votes(text, c, s, e, ok), "features": _features(text, c, s, e)}
                              for c, s, e, ok in found]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").cast(pa.int64()), pa.array(out, pa.list_(span))],
                    ["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, found {_SPANS}")


def estimate(votes: np.ndarray, count: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM for two classes: (probability that each vote pattern is personal data,
    reliabilities [labeler, class, vote -1/0/1])."""
    n, m = votes.shape
    p = np.clip(0.5 + 0.4 * votes.sum(1) / np.maximum(np.abs(votes).sum(1), 1), 0.05, 0.95)
    table = np.zeros((m, 2, 3))
    for _ in range(rounds):
        weight = np.stack([(1 - p) * count, p * count])
        # a labeler starts out better than chance; 1 is the prior's weight
        prior = np.array([[0.5, 0.4, 0.1], [0.1, 0.4, 0.5]])
        for j in range(m):
            for c in range(2):
                table[j, c] = np.bincount(votes[:, j] + 1, weight[c], 3) + prior[c]
                table[j, c] /= table[j, c].sum()
        share = (weight.sum(1) + 1) / (weight.sum() + 2)
        log = np.log(share)[:, None] + sum(np.log(table[j][:, votes[:, j] + 1]) for j in range(m))
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return p, table


def _one_hot(features: np.ndarray) -> np.ndarray:
    at = np.cumsum((0,) + FEATURE_SIZES[:-1])
    x = np.zeros((len(features), sum(FEATURE_SIZES) + 1))
    for j, base in enumerate(at):
        x[np.arange(len(features)), base + features[:, j]] = 1
    x[:, -1] = 1
    return x


def fit_classifier(features: np.ndarray, target: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps (ridge 1)."""
    x = _one_hot(features)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (count * (q - target)) + w
        hess = (x * (count * q * (1 - q))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(found: DataFrame) -> np.ndarray:
    """The span classifier's weights, from candidates of all documents."""
    pattern = (found.where("found is not null").select(F.explode("found").alias("x"))
               .groupBy("x.votes", "x.features").agg(F.count("*").alias("n")).collect())
    weights = np.zeros(sum(FEATURE_SIZES) + 1)
    if not pattern:
        return weights
    # at most 3^labelers * product(FEATURE_SIZES) rows, whatever the input
    pattern.sort(key=lambda r: (r["votes"], r["features"]))
    votes = np.array([r["votes"] for r in pattern])
    features, n = np.array([r["features"] for r in pattern]), np.array([r["n"] for r in pattern], float)
    kind = features[:, 0]
    target = np.zeros(len(n))
    for k in np.unique(kind):  # labelers are not equally good at every kind
        target[kind == k] = estimate(votes[kind == k], n[kind == k])[0]
    return fit_classifier(features, target, n)


def chosen(found: list[dict], weights: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of the spans that stay, by kind, then start."""
    if not found:
        return []
    accept = _one_hot(np.array([f["features"] for f in found])) @ weights > 0
    return sorted((f["kind"], f["start"], f["end"], f["passes"]) for f, a in zip(found, accept)
                  if f["passes"] or a)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    found = written(find_candidates(docs), "candidates")
    weights = learn(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"]
        for batch in batches:
            out = []
            for doc_id, cands in zip(batch.column("doc_id").to_pylist(), batch.column("found").to_pylist()):
                spans = chosen(cands or [], weights)
                n = Counter(KINDS[k] for k, _, _, base in spans if base)
                said = [f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in spans]
                base = ",".join(t for t, x in zip(said, spans) if x[3])
                out.append((doc_id, *[n[k] for k in BASE], hashlib.sha256(base.encode()).hexdigest(),
                            ",".join(said)))
            cols = list(zip(*out)) if out else [[]] * len(names)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return found.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in BASE)
                            + ", base_sha256 string, spans string")


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in its text replaced by its kind in brackets; a
    column n_chars, where there is one, follows the text."""
    weights = learn(written(find_candidates(docs), "candidates"))
    names, schema = docs.columns, docs.schema
    counts = "n_chars" in names

    def mask(text: str, found) -> str:
        spans = sorted((s, e, KINDS[k]) for k, s, e, _ in chosen(
            [{"kind": KINDS.index(c), "start": s, "end": e, "passes": ok,
              "features": _features(text, c, s, e)} for c, s, e, ok in found], weights))
        out, at = [], 0
        for s, e, kind in spans:
            if s >= at:
                out += [text[at:s], f"[{kind.upper()}]"]
            at = max(at, e)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in T.pieces(batch, "text"):
                new = {k: mask(text, found) for k, text, found in _scan(rows, data, off)}
                if new:
                    text = rows.column("text").to_pylist()
                    size = rows.column("n_chars").to_pylist() if counts else None
                    for k, t in new.items():
                        if t != text[k]:
                            text[k] = t
                            if counts:
                                size[k] = len(t)
                    cols = {n: rows.column(n) for n in names}
                    cols["text"] = pa.array(text, rows.schema.field("text").type)
                    if counts:
                        cols["n_chars"] = pa.array(size, rows.schema.field("n_chars").type)
                    rows = pa.RecordBatch.from_arrays(list(cols.values()), names)
                yield rows

    return docs.mapInArrow(run, schema)
