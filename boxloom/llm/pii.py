"""PII spans by weak-supervision aggregation.

A worker finds base spans by exact patterns with checks, and candidate spans by broad ones: addresses
written out with (at), national telephone numbers, account and social security numbers, keys and tokens
(long runs of letters and digits), street addresses, names behind a title, and the base spans themselves.
Labelers vote +1, -1 or 0 on each candidate: shape (regular expression), gazetteer, context words for or
against it, checksum, digit count or entropy, and boundary; they may disagree. How often each combination of kind, votes and features
occurs is counted over the whole corpus; there are at most a few thousand combinations, whatever the
corpus. On these counts, expectation-maximisation estimates how reliable each labeler is and how probable
each combination; a logistic model on the features, fitted to these probabilities, is the span classifier.
Candidates that it accepts are added; base spans always stay.

Defined results: null and empty texts have no spans; repeated rows give a row each; a candidate that
overlaps a base span is never added; a corpus without candidates adds none; very long texts are read as a
whole, in linear time; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import table, tidied, written

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("email_written", "phone_national", "iban", "ssn", "secret", "street", "name")
KINDS = BASE_KINDS + MORE_KINDS
#: A candidate is added from this probability on.
ACCEPT = 0.9

# The first three are the base patterns; a run of their first class is entered at its start only, where that
# is the same, so that long runs take linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_WRITTEN = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[{]at[)\]}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[{]dot[)\]}]) ?[A-Za-z0-9-]{1,63}){1,5}")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z.@+-])\(?[0-9]{2,5}\)?(?:[ ./-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z@])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_NATIONAL = re.compile(r"\(?0?[0-9]{2,4}\)?[ /-][0-9]{3,4}[ -]?[0-9]{3,4}")

# entered at the start of a run only, so that runs of any length take linear time
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+={0,2}(?![A-Za-z0-9+/_=-])")
_HEX = re.compile(r"(?:[0-9a-f]{24,}|[0-9A-F]{24,})")
_STREET = re.compile(r"(?<![A-Za-z0-9.,-])[0-9]{1,5}[a-z]? (?:[A-Z][a-z]{1,20} ){1,3}[A-Z][a-z]{1,10}\b")
_NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof)\b\.? [A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20})?")
_ASSIGNED = re.compile(r"""[A-Za-z]["']? ?(?::|=|:=|=>) ?["']?$""")

#: How keys of well-known services begin, words that streets end on, frequent first names.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_live_", "xoxb-", "xoxp-", "eyJ", "AIza", "glpat-")
STREETS = frozenset("Street St Road Rd Avenue Ave Lane Ln Drive Dr Boulevard Blvd Square Court Way Place".split())
NAMES = frozenset("James Mary John Anna Robert Maria Michael Peter Paul Laura David Thomas Sarah Julia Carlos Marie Pierre Hans".split())
#: Endings of addresses, and states that issue account numbers.
ENDINGS = frozenset("com org net edu gov info biz io de fr es it nl uk eu at ch pl".split())
IBAN_STATES = frozenset("AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
#: Words before a span that speak for or against it.
FOR_WORDS = frozenset("mail email e-mail contact tel phone telephone call fax mobile card account iban ssn reach write at".split())
AGAINST_WORDS = frozenset("version isbn page no number order item id section vol chapter year lines row total".split())


#: The same for keys and tokens.
SECRET_WORDS = frozenset("token key secret password passwd pwd api apikey auth bearer credential credentials access private".split())
HASH_WORDS = frozenset("sha md commit hash digest checksum revision etag build version id uuid path file".split())


def entropy(s: str) -> float:
    """Bits a character."""
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


#: What any pattern starts from.
STARTS = r"[@0-9]|[(\[{]at[)\]}]|\b(?:Mr|Mrs|Ms|Dr|Prof)\b"


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses: from each @, back over the local part as far as no earlier span reaches."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each base kind in order; matches that fail their check are dropped."""
    ips = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    cards = [m.span() for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []
    return {"email": emails(text), "ip": ips, "card": cards, "phone": phones}


def _iban_holds(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _code(kind: int, text: str, a: int, b: int) -> int:
    """Kind, votes and features of a candidate as one integer: the votes in base 3, then the features."""
    span, name = text[a:b], KINDS[kind]
    digits = _digits(span)
    before = text[max(0, a - 30) : a].lower()
    words = re.findall(r"[a-z-]+", before)[-3:]
    shape = {"email_written": "dot" in span or "." in span, "phone_national": bool(_NATIONAL.fullmatch(span)), "secret": bool(_HEX.fullmatch(span)) or (any(c.isupper() for c in span) and any(c.islower() for c in span)), "street": span.rsplit(" ", 1)[-1] in STREETS, "name": span.count(" ") == 2}.get(name, True)
    if name.startswith("email"):
        gazetteer = re.split(r"[^A-Za-z0-9]+", span.rstrip(")]}"))[-1].lower() in ENDINGS
    elif name == "iban":
        gazetteer = span[:2] in IBAN_STATES
    elif name == "secret":
        gazetteer = True if span.startswith(PREFIXES) else None
    elif name == "street":
        gazetteer = span.rsplit(" ", 1)[-1] in STREETS
    elif name == "name":
        gazetteer = True if NAMES & set(span.split(" ")) else None
    else:
        gazetteer = None
    speak_for, against = (SECRET_WORDS, HASH_WORDS) if name == "secret" else (FOR_WORDS, AGAINST_WORDS)
    context = None
    for w in words:  # the nearest word counts
        context = True if w in speak_for else False if w in against else context
    if name == "iban":
        check = _iban_holds(span)
    elif name == "card":
        check = luhn(digits)
    elif name == "ssn":
        check = digits[:3] not in ("000", "666") and digits[0] != "9"
    elif name == "secret":
        turns = len(re.findall(r"[0-9]+|[A-Za-z]+", span))  # random letters and digits take turns
        check = True if entropy(span) >= 3 and turns >= 5 else False if entropy(span) < 2.5 or turns < 3 else None
    elif name.startswith("phone"):
        check = 9 <= len(digits) <= 15
    else:
        check = None
    left, right = text[a - 1 : a], text[b : b + 1]
    assigned = name == "secret" and bool(_ASSIGNED.search(text[max(0, a - 12) : a]))
    bound = assigned if name == "secret" else not (left.isalnum() or right.isalnum())  # a value, not a word of prose
    code = kind
    for vote in (shape, gazetteer, context, check, bound):
        code = code * 3 + (1 if vote is None else 2 * vote)
    for feature in (min(3, len(span) // 8), min(3, len(digits) // 4), int(left.isspace() or not left), int("\n" in text[b : b + 2] or not right), int(assigned or (name != "secret" and "(" in span))):
        code = code * 4 + feature
    return code


N_VOTES, N_FEATURES = 5, 5


def _decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, votes 0-2, features 0-3) of codes."""
    x, features, votes = codes.copy(), [], []
    for _ in range(N_FEATURES):
        features.append(x % 4)
        x //= 4
    for _ in range(N_VOTES):
        votes.append(x % 3)
        x //= 3
    return x, np.stack(votes[::-1], 1), np.stack(features[::-1], 1)


def candidates(text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, code) of all base spans and of further spans that do not overlap them or each other."""
    taken = sorted(x for spans in base.values() for x in spans)
    out = [(k, a, b, _code(k, text, a, b)) for k, name in enumerate(BASE_KINDS) for a, b in base[name]]

    stops = list(accumulate((y for _, y in taken), max))  # spans of different kinds may overlap

    def free(a: int, b: int) -> bool:
        k = bisect_left(taken, (b,))
        return k == 0 or stops[k - 1] <= a

    found: list[tuple[int, int, int]] = []
    if "at" in text:
        found += [(4, *m.span()) for m in _WRITTEN.finditer(text)]
    found += [(6, *m.span()) for m in _IBAN.finditer(text)]
    found += [(8, *m.span()) for m in _SECRET.finditer(text)]
    found += [(9, *m.span()) for m in _STREET.finditer(text)]
    found += [(10, *m.span()) for m in _NAME.finditer(text)]
    found += [(7 if _SSN.fullmatch(m[0]) else 5, *m.span()) for m in _NUMBER.finditer(text) if 7 <= len(_digits(m[0])) <= 12]
    end = -1
    for kind, a, b in sorted(found, key=lambda x: x[1:]):
        if a >= end and free(a, b):
            out.append((kind, a, b, _code(kind, text, a, b)))
            end = b
    return out


def span_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kinds, starts, stops, codes) of each row: arrays of the base spans and candidates in it."""
    # most texts hold nothing that any pattern starts from, and need not travel
    body = F.when(F.col(text).rlike(STARTS), F.col(text))
    schema = f"key {docs.schema[key].dataType.simpleString()}, kinds array<int>, starts array<int>, stops array<int>, codes array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for text_ in batch.column("text").to_pylist():
                rows = candidates(text_, base_spans(text_)) if text_ else []
                for k in range(4):
                    cols[k].append([r[k] for r in rows])
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), *[pa.array(c, pa.list_(t)) for c, t in zip(cols, types)]], ["key", "kinds", "starts", "stops", "codes"])

    return docs.select(F.col(key).alias("key"), body.alias("text")).mapInArrow(tidied(run), schema)


class SpanModel:
    """Reliabilities of the labelers and the classifier, from counts of codes."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, rounds: int = 40, steps: int = 400):
        self.weights: np.ndarray | None = None
        if not len(codes):
            return
        kind, votes, _ = _decode(codes)
        n = counts.astype(float)
        # the majority, to begin with; context counts more, as only it tells a key from a digest
        p = 1 / (1 + np.exp(-1.5 * ((votes - 1) * (1, 1, 2.5, 1, 1)).sum(1)))
        for _ in range(rounds):
            log = np.zeros((len(codes), 2))
            self.reliability = np.zeros((2, N_VOTES, 3))
            for y, q in ((0, 1 - p), (1, p)):
                for j in range(N_VOTES):
                    seen = np.bincount(votes[:, j], n * q, 3) + (2, 1, 1 + y)
                    self.reliability[y, j] = seen / seen.sum()
                    log[:, y] += np.log(self.reliability[y, j][votes[:, j]])
                prior = np.bincount(kind, n * q, len(KINDS)) + 1
                total = np.bincount(kind, n, len(KINDS)) + 2
                log[:, y] += np.log((prior / total)[kind])
            p = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        self.probability = p
        x = self.features(codes)
        w = np.zeros(x.shape[1])
        share = n / n.sum()
        # rare kinds count as much as frequent ones, so that base spans do not decide alone
        share = share / (np.bincount(kind, share, len(KINDS))[kind])
        share /= share.sum()
        for _ in range(steps):
            guess = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
            w -= 4.0 * (x.T @ (share * (guess - p)) + 1e-4 * w)
        self.weights = w

    @staticmethod
    def features(codes: np.ndarray) -> np.ndarray:
        kind, votes, features = _decode(codes)
        cols = [np.eye(len(KINDS))[kind]]
        cols += [np.eye(3)[votes[:, j]] for j in range(N_VOTES)]
        cols += [np.eye(4)[features[:, j]] for j in range(N_FEATURES)]
        return np.concatenate(cols, 1)

    def score(self, codes: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(codes))
        return 1 / (1 + np.exp(-np.clip(self.features(codes) @ self.weights, -50, 50)))


def train(spans: DataFrame) -> SpanModel:
    """The model for the candidates of a ``span_table``; the driver gets the distinct codes with their counts."""
    got = spans.select(F.explode("codes").alias("code")).groupBy("code").count().toPandas().sort_values("code")
    return SpanModel(got["code"].to_numpy(np.int64), got["count"].to_numpy(np.int64))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``key``, counts and digest of base spans, all spans and how many they are, of each row of ``docs``."""
    spans = written(span_table(docs, key, text))
    model = train(spans)
    names = [key, *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_spans"]
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, " + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string, n_spans long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for kinds, starts, stops, codes in zip(*(batch.column(c).to_pylist() for c in ("kinds", "starts", "stops", "codes"))):
                every = sorted(zip(kinds, starts, stops))
                base = [x for x in every if x[0] < len(BASE_KINDS)]
                if len(base) < len(every):
                    good = model.score(np.array(codes, np.int64)) >= accept
                    every = sorted(x for x, g in zip(zip(kinds, starts, stops), good) if g or x[0] < len(BASE_KINDS))
                said = [",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in xs) for xs in (base, every)]
                rows.append((*[sum(k == i for k, _, _ in base) for i in range(4)], hashlib.sha256(said[0].encode()).hexdigest(), said[1], len(every)))
            cols = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *[pa.array(c, t) for c, t in zip(cols, types)]], names)

    return spans.mapInArrow(tidied(run), schema)


def redact(docs: DataFrame, text: str = "text", accept: float = ACCEPT, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with each span in ``text`` replaced by its kind in brackets; other columns as they are."""
    model = model or train(written(span_table(docs.select(F.lit(0).alias("k"), F.col(text).alias("t")), "k", "t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for t in batch.column(at).to_pylist():
                rows = candidates(t, base_spans(t)) if t else []
                good = model.score(np.array([r[3] for r in rows], np.int64)) >= accept if rows else []
                spans = sorted((a, b, k) for (k, a, b, _), g in zip(rows, good) if g or k < len(BASE_KINDS))
                done, parts = 0, []
                for a, b, k in spans:
                    if b <= done:
                        continue
                    parts.append(t[done:max(a, done)])
                    if a >= done:
                        parts.append(f"[{KINDS[k]}]")
                    done = b
                out.append(t if not spans else "".join([*parts, t[done:]]))
            yield batch.set_column(at, text, pa.array(out, pa.string()))

    hit = F.col(text).rlike(STARTS)
    clean = docs.where(~F.coalesce(hit, F.lit(False)))
    return clean.unionByName(docs.where(F.coalesce(hit, F.lit(False))).mapInArrow(tidied(run), docs.schema))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))


QUERIES = {"op4_pii": op4_pii}
