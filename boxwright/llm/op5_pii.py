"""Personal data by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always stay. Further candidates (long tokens,
digit groups, spelled-out addresses, names after a title, street addresses) get votes of four labelers, each of which
may abstain: a *pattern* labeler (the form that a regular expression asks for), a *gazetteer* labeler (words in front
that announce personal data, or that announce something else), a *context* labeler (marks around the span) and a
*spread* labeler (how varied the characters are). One pass counts patterns of votes and features over all documents, a
bounded table; expectation-maximisation on it estimates each labeler's reliability and every pattern's posterior;
a logistic span classifier is trained on these soft labels (base spans count as positives). It sees what labelers do not:
the kind, the length, the share of digits, case and separators, beside what stands around. A second
pass applies it: candidates of probability 0.5 or more become spans.

Defined results: null and empty texts have no span; an added span never overlaps a base span or an earlier added one
(of candidates that start together the longer one, then the kind listed first); equal rows each get a row; texts of any
length are searched whole, in linear time; an empty table gives an empty result, and with no candidate no span is added.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwright.llm._shared import documents

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "number", "address", "person", "street")
ORDER = {k: i for i, k in enumerate(KINDS)}
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A run of digits is taken whole from its first digit, as the plain pattern does; possessive, so a long run stays linear.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
SECRET = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}+")
NUMBER = re.compile(r"(?<![0-9A-Za-z+.])\(?[0-9][0-9 ().-]{5,40}[0-9](?![0-9A-Za-z])")
SPELLED = re.compile(r"[A-Za-z0-9._-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,64} ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}")
PERSON = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme)\.? [A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30}){0,2}\b")
STREET = re.compile(r"\b[0-9]{1,5} (?:[A-Z][a-z]{1,30} ){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Drive|Square|Court)\b")
#: Words that stand in front of personal data or a secret, and words that stand in front of other numbers and codes.
GAZETTEER = frozenset("token key secret password passwd pwd apikey api_key bearer auth credential credentials login phone tel telephone mobile cell fax call contact ssn iban account passport licence license mail email e-mail write reach lives at name by from dear".split())
OTHERS = frozenset("page pages isbn issn doi version v commit sha md5 build figure fig table chapter section line lines article order invoice item model serial revision rev total sum about nearly over under between since until year years".split())
LABELERS, FEATURES, RIDGE = 4, 23, 1e-5
#: Prior rows of a labeler by class (not, personal) and vote (index 1: for, -1: against).
PRIOR = np.array([[0.0, 2.0, 8.0], [0.0, 8.0, 2.0]])
PATTERN = "kind string, votes array<int>, features array<int>, n long"
_MARK = re.compile(r"""[=:]\s*["']?$""")
_WORD = re.compile(r"[A-Za-z_-]+")
_GROUPED = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}")
_YEARS = re.compile(r"(?:1[0-9]|20)[0-9]{2}[ -](?:1[0-9]|20)[0-9]{2}|(?:1[0-9]|20)[0-9]{2}-[01][0-9]-[0-3][0-9].*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) << (k & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part reaches from the '@' back to a foreign character or the match before."""
    at, done = text.find("@"), 0
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                done = m.end()
                yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four base kinds."""
    out = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text) if "." in text else ():
            if all(len(g) <= 3 and int(g or 0) <= 255 for g in (g.lstrip("0") for g in m.groups())):
                out.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((*m.span(), "phone"))
    return out


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what may be personal data beyond the base kinds."""
    out = []
    if DIGIT.search(text):
        out += [(*m.span(), "secret") for m in SECRET.finditer(text) if DIGIT.search(m[0])]
        out += [(*m.span(), "number") for m in NUMBER.finditer(text) if 7 <= sum(c.isdigit() for c in m[0]) <= 20]
        out += [(*m.span(), "street") for m in STREET.finditer(text)]
    if ("(at)" in text or "[at]" in text or " at " in text) and ("(dot)" in text or "[dot]" in text or " dot " in text):
        out += [(*m.span(), "address") for m in SPELLED.finditer(text)]
    if TITLE.search(text):
        out += [(*m.span(), "person") for m in PERSON.finditer(text)]
    return out


TITLE = re.compile(r"M[rs]|Dr|Prof|Herr|Frau|Sr|Mme")


def spread(span: str) -> float:
    """Bits a character of the span's own frequencies."""
    return -sum(n / len(span) * math.log2(n / len(span)) for n in Counter(span).values())


def describe(text: str, start: int, end: int, kind: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Votes (1 personal, -1 not, 0 abstains) and binary features of a span."""
    span, front, back = text[start:end], text[max(0, start - 24) : start], text[end : end + 2]
    digits = sum(c in "0123456789" for c in span)
    # pattern: a form that is asked for; a bare code of letters or a date is against
    if kind == "secret":
        hexed = len(span) in (32, 40, 64) and all(c in "0123456789abcdef" for c in span.lower())
        pattern = 1 if hexed or 4 <= digits <= 0.8 * len(span) else -1
    elif kind == "number":
        pattern = 1 if _GROUPED.fullmatch(span) else -1
    else:
        pattern = 1
    said_ = [w.lower() for w in _WORD.findall(front)[-2:]] if front[-1:] not in "\n" else []
    listed, other = any(w in GAZETTEER for w in said_), any(w in OTHERS for w in said_[-1:])
    gazetteer = 1 if listed and not other else -1 if other and not listed else 0
    assigned = bool(_MARK.search(front))
    quoted = front[-1:] != "" and front[-1:] in "\"'" and back[:1] == front[-1:]
    joined = front[-1:] != "" and front[-1:] in "/#@&?.-_" or back[:1] != "" and back[:1] in "/@="
    context = 1 if assigned or quoted else -1 if joined or (kind == "number" and bool(_YEARS.fullmatch(span))) else 0
    bits = spread(span)
    if kind == "secret":
        varied = 1 if bits >= 3.5 else -1 if bits < 2.8 else 0
    elif kind == "number":
        varied = -1 if bits < 1.8 else 0
    else:
        varied = 0
    share = digits / len(span)
    shape = [len(span) < 12, 12 <= len(span) < 24, 24 <= len(span) < 48, len(span) >= 48, share < 0.1, 0.1 <= share < 0.6, share >= 0.6]
    shape += [any(c.isupper() for c in span), any(c.islower() for c in span), any(c in " -.()_" for c in span)]
    features = [1, *(kind == k for k in ("secret", "number", "address", "person", "street")), kind in BASE, *shape, listed, other, assigned, quoted, joined, bits >= 3.5]
    return (pattern, gazetteer, context, varied), tuple(map(int, features))


def free(spans: list[tuple[int, int, str]], taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans that overlap neither a taken one nor an earlier one of their own."""
    if not spans:
        return []
    blocked, out = sorted((a, b) for a, b, _ in taken), []
    reach, at, end = -1, 0, -1
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1], ORDER[s[2]])):
        while at < len(blocked) and blocked[at][0] < b:
            reach = max(reach, blocked[at][1])
            at += 1
        if a >= reach and a >= end:
            out.append((a, b, kind))
            end = b
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if text:
                base = base_spans(text)
                for a, b, kind in [*base, *free(candidates(text), base)]:
                    seen[("base" if kind in BASE else kind, *describe(text, a, b, kind))] += 1
    if seen:
        yield pa.RecordBatch.from_pylist([{"kind": k, "votes": v, "features": f, "n": n} for (k, v, f), n in seen.items()], pa.schema([("kind", pa.string()), ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32())), ("n", pa.int64())]))


def patterns(docs: DataFrame) -> list:
    """Counts of (kind, votes, features) over all documents.

    Both take few values, whatever the number of documents: features are a kind, one of four lengths, one of three shares
    of digits, three marks of form and six of surroundings, and votes follow from them but for the pattern and the spread.
    """
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, PATTERN)
    return counted.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).orderBy("kind", "votes", "features").collect()


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, known: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each pattern, and P(vote | class) as (labeler, class, vote + 1); known: 1 for sure positives, else nan.

    Starts from the majority vote. Reliabilities are those of votes cast, as abstentions carry no evidence; PRIOR rows
    of each class (more of them in agreement) keep few candidates from turning a labeler around.
    """
    post = np.where(np.isnan(known), 1 / (1 + np.exp(-votes.sum(1))), known)
    table = np.full((votes.shape[1], 2, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([(1 - post) * n, post * n])
        open_ = np.isnan(known)
        prior = ((post * n)[open_].sum() + 1) / (n[open_].sum() + 2)
        for j in range(votes.shape[1]):
            table[j, :, 1] = 0
            for v in (-1, 1):
                table[j, :, v + 1] = weight[:, votes[:, j] == v].sum(1) + PRIOR[:, v]
            table[j] /= table[j].sum(1, keepdims=True)
        logit = np.full(len(n), np.log(prior / (1 - prior)))
        for j in range(votes.shape[1]):
            cast = votes[:, j] != 0
            logit[cast] += np.log(table[j, 1, votes[cast, j] + 1] / table[j, 0, votes[cast, j] + 1])
        post = np.where(open_, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), known)
    return post, table


def train(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the span classifier on describe()'s features, and the labelers' reliabilities."""
    if not rows:
        return np.zeros(FEATURES), np.full((LABELERS, 2, 3), 1 / 3)
    votes, feats, n = np.array([r.votes for r in rows]), np.array([r.features for r in rows], float), np.array([r.n for r in rows], float)
    post, table = expectation_maximisation(votes, n, np.array([1.0 if r.kind == "base" else np.nan for r in rows]))
    x, share = feats, n / n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - post)) + RIDGE * w
        w -= np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), grad)
    return w, table


def find(text: str, weights: np.ndarray) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans, by start, then kind."""
    key = lambda s: (s[0], ORDER[s[2]], s[1])
    base = sorted(base_spans(text), key=key)
    added = []
    for a, b, kind in free(candidates(text), base):
        if weights.any() and np.dot(weights, describe(text, a, b, kind)[1]) >= 0:
            added.append((a, b, kind))
    return base, sorted([*base, *added], key=key) if added else base


def said(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _finder(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text in batch.column("text").to_pylist():
                base, every = find(text, weights) if text else ([], [])
                kinds = [k for *_, k in base]
                for c, v in zip(cols, (*map(kinds.count, BASE), hashlib.sha256(said(base).encode()).hexdigest(), said(every)), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])], [x.split()[0] for x in FOUND.split(", ")])

    return run


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans, of each whole text."""
    weights, _ = train(patterns(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_finder(weights), FOUND)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each maximal run of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _masker(weights: np.ndarray, text_at: int, size_at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            sizes = batch.column(size_at).to_pylist() if size_at is not None else None
            for k, text in enumerate(texts):
                if text and (spans := find(text, weights)[1]):
                    texts[k] = mask(text, spans)
                    if sizes is not None:
                        sizes[k] = len(texts[k])
            new = {text_at: pa.array(texts, pa.string())} | ({size_at: pa.array(sizes, pa.int64())} if size_at is not None else {})
            yield pa.RecordBatch.from_arrays([new.get(k, c) for k, c in enumerate(batch.columns)], batch.schema.names)

    return run


def redact(docs: DataFrame) -> DataFrame:
    """All documents and columns, with every found span replaced by a mark of its kind; n_chars (if there is one) follows."""
    weights, _ = train(patterns(docs))
    kinds = {"text": "string", "n_chars": "long"}
    rows = docs.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in docs.columns))
    names = rows.columns
    plain = rows.toDF(*(f"c{k}" for k in range(len(names))))  # a name with a dot does not get through mapInArrow
    return plain.mapInArrow(_masker(weights, names.index("text"), names.index("n_chars") if "n_chars" in names else None), plain.schema).toDF(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)
