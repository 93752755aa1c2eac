"""Operator 12: personal data by weak supervision.

Every text is searched for what the kinds' strict patterns (base) match, and for spans that look like
one of the kinds in another notation or fail its check. On each such span labelers vote for,
against or not at all: regex labelers (form, structure, signs of another kind of number), gazetteer
labelers (known endings, issuers, prefixes, networks; values that are placeholders) and context labelers
(words before the span, what it touches). Votes of all spans of all documents are counted by pattern;
expectation-maximisation on these counts estimates how each labeler votes on personal data and on
other spans, with base spans known to be personal data. The posterior of a span's votes is its soft label,
and a logistic classifier of votes, shape and neighbouring words is trained on a bounded sample of
spans (TRAIN_SPANS). It decides on every span that is not base; one that it takes must also pass
the check of its kind. Base spans always stay, and added ones overlap neither them nor one another.

Texts are read once and whole; patterns take time linear in the text. The driver gets vote
patterns (at most 4 * 2 * 3 ** 8) and the sample.

Defined cases: null and empty texts have no span; a row is a document, with whatever doc_id; equal texts
get equal spans; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from airlens.llm.common import hash_sample, materialize, slices

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
FAILED, OTHER, BASE = 0, 1, 2   # fails its kind's check; another notation; a base match
#: Spans that the classifier is trained on, and the score from which a span is added.
TRAIN_SPANS, TAKE = 20_000, 0.9
#: Bins for the word before and the word after a span.
WORD_BINS = 32

# --- base patterns: leftmost, non-overlapping, per kind ---------------------
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGIT_RUN = re.compile(r"[0-9][0-9 -]*")
_GAP = re.compile(r"[ -]{2,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(x if x < 10 else x - 9 for x in (2 * int(d) for d in digits[-2::-2]))
    return (odd + even) % 10 == 0


def checked(kind: int, text: str) -> bool:
    """The check of a kind's values, in any notation."""
    if kind == EMAIL:
        return True
    if kind == IP:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
    digits = _digits(text)
    if kind == CARD:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def matches(text: str):
    """(kind, start, end) of what the base patterns match, before their checks."""
    done = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():   # from the @ outwards: the local part is the run before it
        start = m.start()
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < m.start():
            done = m.end()
            yield EMAIL, start, done
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        yield IP, m.start(), m.end()
    for m in _DIGIT_RUN.finditer(text):   # digits with single separators: cut where there are two, drop what hangs over
        if m.end() - m.start() < 2:
            continue
        at = m.start()
        for gap in [*_GAP.finditer(m[0]), None]:
            end = m.end() if gap is None else m.start() + gap.start()
            while end > at and text[end - 1] in " -":
                end -= 1
            if end - at > 1:
                yield CARD, at, end
            if gap is not None:
                at = m.start() + gap.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield PHONE, m.start(), m.end()


# --- spans in other notations ----------------------------------------------
_AT = re.compile(r"\s?[(\[{<]\s?(?:at|AT|@)\s?[)\]}>]\s?|\s(?:at|AT)\s")
_SPELT_DOT = r"\s?[(\[{]\s?(?:dot|DOT|\.)\s?[)\]}]\s?|\s(?:dot|DOT)\s"
_DOMAIN_OTHER = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:(?:{_SPELT_DOT}|\.)[A-Za-z0-9-]{{1,63}}){{1,8}}")
_IP_OTHER = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:{_SPELT_DOT})[0-9]{{1,3}}){{3}}(?![0-9])")
_CARD_OTHER = re.compile(r"(?<![0-9])[0-9]{4}([./_  ‐-―]| {2}| - )[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])")
_PHONE_OTHER = re.compile(r"(?<![0-9+.,/-])(?<![0-9][ .,/-])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{3,4}[ ./-][0-9]{3,4}(?![ ./-]?[0-9])")


def other_notations(text: str):
    """(kind, start, end) of spans that read like a kind but are written in another way."""
    done = 0
    for m in _AT.finditer(text):
        local = _LOCAL.search(text, max(done, m.start() - 64), m.start())
        domain = _DOMAIN_OTHER.match(text, m.end())
        if local and local[0] and domain and (m[0].strip().lower() != "at" or "dot" in domain[0].lower()):
            done = domain.end()
            yield EMAIL, local.start(), done
    if _DIGIT.search(text):
        for kind, pattern in ((IP, _IP_OTHER), (CARD, _CARD_OTHER), (PHONE, _PHONE_OTHER)):
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end()


def spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, status) of all spans of a text, in order; those that are not base overlap no base span."""
    found = [(s, k, e, BASE if checked(k, text[s:e]) else FAILED) for k, s, e in matches(text)]
    # a run of digits is a failed card only at a card's length, a failed phone at half of a phone's
    found = [f for f in found if f[3] == BASE or f[1] == IP or (f[1] == CARD and 12 <= len(_digits(text[f[0]:f[2]])) <= 19)
             or (f[1] == PHONE and len(_digits(text[f[0]:f[2]])) >= 5)]
    more = [(s, k, e, OTHER if checked(k, text[s:e]) else FAILED) for k, s, e in other_notations(text)]
    if not found and not more:
        return []
    taken = sorted((s, e) for s, _, e, status in found if status == BASE)
    starts = np.array([t[0] for t in taken], np.int64)
    ends = np.maximum.accumulate(np.array([t[1] for t in taken], np.int64)) if taken else starts

    def free(s, e):
        i = np.searchsorted(starts, e)   # base spans that begin before e
        return i == 0 or ends[i - 1] <= s

    return sorted([f for f in found if f[3] == BASE or free(f[0], f[2])] + [f for f in more if free(f[0], f[2])])


# --- labelers ---------------------------------------------------------------
# fixed values: words and prefixes that speak for or against a kind
CUES = (
    re.compile(r"\b(?:e-?mail|mail|contact|write|reach|correo|courriel|kontakt|schreib)", re.I),
    re.compile(r"\b(?:ip|address|host|server|client|login|adresse|servidor|serveur)\b", re.I),
    re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|kreditkarte|tarjeta|carte)\b", re.I),
    re.compile(r"\b(?:phone|tel|telephone|call|fax|mobile|cell|whatsapp|telefon|anruf|tel[eé]fono|llam|t[eé]l[eé]phone|appel)", re.I))
COUNTER_CUES = re.compile(r"\b(?:version|isbn|issn|doi|order|invoice|ticket|serial|sku|page|figure|table|chapter|date|build|release|section|"
                          r"token|key|hash|commit|rechnung|pedido|factura|commande)\b", re.I)
ENDINGS = frozenset("com org net edu gov mil int info io co biz dev app de fr es it uk us eu ch at nl be pl pt br mx ar cl jp cn in au ca".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|38|62")
CALLING = re.compile(r"\+?(?:00)?(?:1|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])")
DATE = re.compile(r"(?:19|20)[0-9]{2}[ ./-][01]?[0-9][ ./-][0-3]?[0-9]|[0-3]?[0-9][ ./-][01]?[0-9][ ./-](?:19|20)[0-9]{2}")
FORMS = (
    re.compile(r"[A-Za-z0-9].{4,252}[A-Za-z]\Z", re.S),
    re.compile(r"[0-9]{1,3}(?:[^0-9]+[0-9]{1,3}){3}\Z"),
    re.compile(r"[0-9]{12,19}\Z|[0-9]{4}(?:[^0-9]{1,3}[0-9]{1,4}){2,4}\Z|[0-9]{4}[^0-9]{1,3}[0-9]{6}[^0-9]{1,3}[0-9]{5}\Z"),
    re.compile(r"(?:\+|00)?[0-9]{0,3}[ .(-]*[0-9]{2,4}[ .)/-]+[0-9]{3,4}[ ./-]*[0-9]{2,4}\Z"))
_WORD = re.compile(r"[^\W\d_]+")
LABELERS = 8


def votes(text: str, start: int, end: int, kind: int) -> list[int]:
    """Each labeler's vote on a span: 1 for personal data, -1 against it, 0 none."""
    span, before, after = text[start:end], text[max(0, start - 48):start], text[end:end + 24]
    digits = _digits(span)
    touch = before[-1:], after[:1]
    if kind == EMAIL:
        ending = re.split(r"[^A-Za-z]+", span.lower())[-1]
        structure = 1 if 2 <= len(ending) <= 24 else -1
        known, placeholder = (1 if ending in ENDINGS else 0), span.lower().startswith(("noreply", "no-reply", "@"))
    elif kind == IP:
        structure = 1 if checked(IP, span) else -1
        known = -1 if digits.startswith("0") else 1 if structure > 0 else 0
        placeholder = len(set(digits)) == 1
    elif kind == CARD:
        structure = 1 if luhn(digits) else -1
        known, placeholder = (1 if ISSUERS.match(digits) else -1), len(set(digits)) <= 2
    else:
        structure = 1 if 9 <= len(digits) <= 13 else -1
        known, placeholder = (1 if CALLING.match(span.lstrip("(")) else 0), len(set(digits)) <= 2
    return [
        1 if FORMS[kind].match(span) else -1,                                                    # regex: canonical form
        structure,                                                                               # regex: structure
        -1 if kind != EMAIL and (DATE.match(span) or touch[0] in "$€£#%/=" and touch[0]) else 0,  # regex: another kind of number
        known,                                                                                   # gazetteer: known parts
        -1 if placeholder else 0,                                                                # gazetteer: placeholders
        1 if CUES[kind].search(before) else 0,                                                   # context: words of the kind
        -1 if COUNTER_CUES.search(before[-24:]) else 0,                                          # context: words of other kinds
        -1 if (touch[0].isalnum() or touch[0] == "_" or touch[1].isalnum() or touch[1] == "_") else 1]   # context: what it touches


def pattern(v: list[int]) -> int:
    code = 0
    for x in v:
        code = 3 * code + x + 1
    return code


def unpack(codes: np.ndarray) -> np.ndarray:
    """Votes (0, 1, 2 for against, none, for) of patterns, one row each."""
    return np.stack([codes // 3 ** (LABELERS - 1 - i) % 3 for i in range(LABELERS)], 1).astype(np.int64).reshape(-1, LABELERS)


def _bin(words: list[str], last: bool) -> int:
    return zlib.crc32(words[-1 if last else 0].lower().encode()) % WORD_BINS if words else 0


_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("status", pa.int32()), ("votes", pa.int32()),
                             ("digits", pa.int32()), ("before", pa.int32()), ("after", pa.int32())]))
FOUND = ("doc_id long, found array<struct<kind int, start long, end long, status int, votes int, digits int, before int, after int>>")


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, found) of every document: its spans with their votes and shape."""
    def search(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    rows.append([] if not text else [
                        (kind, start, end, status, pattern(votes(text, start, end, kind)), len(_digits(text[start:end])),
                         _bin(_WORD.findall(text[max(0, start - 24):start]), True), _bin(_WORD.findall(text[end:end + 24]), False))
                        for start, kind, end, status in spans(text)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([[dict(zip(_NAMES, r)) for r in row] for row in rows], _SPANS)],
                                                 names=["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(search, FOUND)


_NAMES = [f.name for f in _SPANS.value_type]


# --- reliabilities ----------------------------------------------------------
def reliabilities(v: np.ndarray, known: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns ``v`` (rows of 0, 1, 2) with counts ``n``; ``known``
    rows are personal data. Returns the prior of unknown rows and log P(vote | class) by class,
    labeler and vote. As a start, and as a prior worth a few spans, labelers are better than chance."""
    better = np.array([[0.6, 0.3, 0.1], [0.1, 0.3, 0.6]])   # against, none, for; on other spans and on personal data
    weight = 10.0
    chance = np.repeat(np.log(better)[:, None, :], LABELERS, axis=1)
    prior = 0.5
    seen = np.eye(3)[v]   # rows, labelers, votes
    for _ in range(rounds):
        post = posterior(v, known, prior, chance)
        new = np.stack([(seen * (n * p)[:, None, None]).sum(axis=0) for p in (1 - post, post)]) + weight * better[:, None, :]
        new = np.log(new / new.sum(axis=2, keepdims=True))
        free = n * ~known
        prior = float(((free * post).sum() + weight / 2) / (free.sum() + weight))
        if np.abs(new - chance).max() < 1e-6:
            break
        chance = new
    return prior, chance


def posterior(v: np.ndarray, known: np.ndarray, prior: float, chance: np.ndarray) -> np.ndarray:
    """How likely each row of votes is personal data; 1 where that is known."""
    each = np.arange(LABELERS)
    gap = np.log(prior / (1 - prior)) + chance[1][each, v].sum(axis=1) - chance[0][each, v].sum(axis=1)
    return np.where(known, 1.0, 1 / (1 + np.exp(-np.clip(gap, -500, 500))))


# --- classifier -------------------------------------------------------------
def features(votes_: np.ndarray, digits: np.ndarray, length: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    v = unpack(votes_)
    return np.concatenate([np.ones((len(v), 1)), (v == 2), (v == 0), np.minimum(digits, 20)[:, None] / 20, np.minimum(length, 60)[:, None] / 60,
                           np.eye(WORD_BINS)[before], np.eye(WORD_BINS)[after]], axis=1).astype(np.float64)


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic classifier with soft labels ``y``, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(found: DataFrame) -> dict[int, np.ndarray]:
    """Weights by kind, from the spans of all documents."""
    rows = found.select("doc_id", F.explode("found").alias("s")).select("doc_id", "s.*")
    counted = rows.groupBy("kind", "votes", (F.col("status") == BASE).alias("base")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    sample = hash_sample(rows, TRAIN_SPANS, "doc_id", "kind", "start").toPandas()
    weights = {}
    for kind in range(len(KINDS)):
        mine = counted[counted.kind == kind]
        prior, chance = reliabilities(unpack(mine.votes.to_numpy(np.int64)), mine.base.to_numpy(bool), mine.n.to_numpy(np.float64))
        s = sample[sample.kind == kind].sort_values(["doc_id", "start"])
        code = s.votes.to_numpy(np.int64)
        y = posterior(unpack(code), s.status.to_numpy() == BASE, prior, chance)
        x = features(code, s.digits.to_numpy(), (s.end - s.start).to_numpy(), s.before.to_numpy(), s.after.to_numpy())
        # one span that all labelers are for and one that they are against, as what the reliabilities start from
        ends = np.array([3 ** LABELERS - 1, 0], np.int64)
        zero = np.zeros(2, np.int64)
        x = np.concatenate([x, features(ends, zero + (12 if kind else 0), zero + 16, zero, zero)])
        weights[kind] = fit(x, np.append(y, [1.0, 0.0]), np.append(np.ones(len(y)), [10.0, 10.0]))
    return weights


def scores(rows: list[dict], weights: dict[int, np.ndarray]) -> np.ndarray:
    column = {c: np.array([r[c] for r in rows], np.int64) for c in _NAMES}
    x = features(column["votes"], column["digits"], column["end"] - column["start"], column["before"], column["after"])
    w = np.stack([weights[k] for k in range(len(KINDS))])[column["kind"]]
    return 1 / (1 + np.exp(-np.clip((x * w).sum(axis=1), -500, 500)))


def chosen(found: list[dict], weights: dict[int, np.ndarray]) -> list[dict]:
    """The base spans and the added ones, the likelier first where added ones overlap."""
    base, others = [r for r in found if r["status"] == BASE], [r for r in found if r["status"] == OTHER]
    if not others:
        return base
    p = scores(others, weights)
    added, starts, ends = [], [], []
    for score, _, i in sorted(zip(-p, (r["start"] for r in others), range(len(others)))):
        r = others[i]
        at = bisect.bisect_left(starts, r["start"])
        if -score >= TAKE and (at == 0 or ends[at - 1] <= r["start"]) and (at == len(starts) or starts[at] >= r["end"]):
            starts.insert(at, r["start"])
            ends.insert(at, r["end"])
            added.append(r)
    return sorted([*base, *added], key=lambda r: (r["start"], r["kind"]))


def _joined(rows: list[dict]) -> str:
    return ",".join(f"{KINDS[r['kind']]}:{r['start']}:{r['end']}" for r in rows)


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """One row of RESULT per row of ``docs``."""
    found = materialize(find_spans(docs), "spans")
    weights = train(found)   # a few hundred numbers

    def decide(batches):
        for batch in batches:
            rows = batch.column("found").to_pylist()
            base = [[r for r in row if r["status"] == BASE] for row in rows]
            counts = [[sum(r["kind"] == k for r in row) for row in base] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(_joined(row).encode()).hexdigest() for row in base]),
                 pa.array([_joined(chosen(row, weights)) for row in rows], pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return found.mapInArrow(decide, RESULT)
