"""Personal data by weak supervision: labelers vote on spans, their reliabilities are estimated, a classifier decides.

Five kinds of spans: email, ip, card, phone and secret (keys and tokens). Spans of the strict base patterns of
the first four always count. Looser patterns propose further candidates: written-out addresses, cards in odd
groups or with a wrong checksum, numbers without a country code, long mixed tokens. Labelers vote yes, no or
not at all on every span:

* regex: yes if the shape fits a strict form of the kind;
* gazetteer: domain endings, number ranges of card issuers, calling codes, reserved address ranges, prefixes of keys;
* context: words to the left that announce the kind, or speak against it;
* checks: checksum, ranges, lengths, variety of characters.

Spark counts how often each pattern of votes and features occurs, over all texts; there are at most
a few thousand patterns, whatever the data. Expectation-maximisation on those counts estimates how
reliable each labeler is and how likely each pattern is personal data; a logistic classifier is
trained on the features with these likelihoods as its labels. It decides on the candidates
that are not base spans.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import map_batches, text_slices

KINDS = ("email", "ip", "card", "phone")
#: The base kinds, and the one that only the method finds.
ALL_KINDS = (*KINDS, "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
LABELERS = ("regex", "gazetteer", "context", "checks")
#: A candidate is kept from this likelihood on.
THRESHOLD = 0.8

# Base spans ---------------------------------------------------------------------------------------

_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_PART = re.compile(r"[0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign and dotted domain, in time linear in the text."""
    at, free = text.find("@"), 0
    while at >= 0:
        if at >= free:
            before = text[free:at]
            start = free + len(before.rstrip(_LOCAL))
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                yield start, domain.end()
            free = domain.end() if domain else at + 1
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    """Four dotted numbers, from the left, and whether all are at most 255."""
    for run in _DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            parts = [(m.start(), m.end()) for m in _PART.finditer(text, run.start(), run.end())]
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                yield four[0][0], four[3][1], all(_octet(text[a:b]) for a, b in four)


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the strict patterns in code points, sorted; failing matches are dropped, not retried."""
    found = [(a, EMAIL, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(a, IP, b) for a, b, valid in _addresses(text) if valid]
        for m in _DIGITS.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _only_digits(m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), CARD, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_only_digits(m.group())) <= 15:
                    found.append((m.start(), PHONE, m.end()))
    return sorted(found)


# Further candidates --------------------------------------------------------------------------------

_MARKED_AT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)|\{at\}) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[A-Za-z0-9-]{1,63}){1,4}", re.I
)
_ODD_CARD = re.compile(r"(?<![0-9A-Za-z.+])[0-9]{4}(?:([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9A-Za-z.])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z.+,/-])(?:\([0-9]{2,5}\) ?|0[0-9]{1,4}[ /-])[0-9]{3,5}(?:[ -][0-9]{2,5}){0,3}(?![0-9A-Za-z])")
_TEXT_ADDRESS = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\[\.\] ?[0-9]{1,3}){3}(?![0-9.])")
_MARK = re.compile(r"[\[({]at[\])}]", re.I)
_GROUPED = re.compile(r"(?<![0-9A-Za-z.+,/_-])[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}(?![0-9A-Za-z.,/_-])")
_LONG_TOKEN = re.compile(r"(?<![A-Za-z0-9_+/=.-])[A-Za-z0-9_+/-]{20,}={0,2}(?![A-Za-z0-9_+/=@-])")
_LETTER = re.compile(r"[A-Za-z]")

# Words that announce a kind (or speak against it) in the four languages of the tables and English forms.
_ANNOUNCE = (
    frozenset("mail email e-mail contact kontakt courriel correo write schreiben escribir".split()),
    frozenset("ip host server address adresse dirección addr".split()),
    frozenset("card visa mastercard credit karte kreditkarte carte tarjeta".split()),
    frozenset("tel phone call mobile fax telefon telefono teléfono téléphone handy portable móvil".split()),
    frozenset("token key secret password passwd pwd apikey api_key api-key bearer auth credential credentials passwort schlüssel contraseña clave".split()),
)
_NO_NUMBER = frozenset("version v release token key hash sha id isbn page seite chapter figure order invoice".split())
_AGAINST = (*[_NO_NUMBER] * 4, frozenset("sha sha1 sha256 md5 hash digest checksum commit revision rev etag uuid id file path url".split()))
# Generic endings of domains (two letters are a country's), and reserved ones.
_ENDINGS = frozenset(
    "com org net edu gov mil int info biz name pro mobi app dev cloud online site store shop tech blog news email media live agency group museum travel jobs cat asia aero coop".split()
)
_NO_ENDINGS = frozenset("test example invalid localhost local internal lan home corp".split())
_NO_HOST = ("0.", "127.", "255.")
# First digits of card numbers by issuer (from, to) and the lengths of its numbers.
_ISSUERS = (
    (4, 4, (13, 16, 19)), (51, 55, (16,)), (2221, 2720, (16,)), (34, 34, (15,)), (37, 37, (15,)), (300, 305, (14, 16)), (36, 36, (14,)), (38, 39, (14, 16)),
    (6011, 6011, (16, 19)), (644, 649, (16, 19)), (65, 65, (16, 19)), (3528, 3589, (16, 19)), (62, 62, (16, 17, 18, 19)), (50, 50, (12, 13, 14, 15, 16, 17, 18, 19)),
    (56, 58, (12, 13, 14, 15, 16, 17, 18, 19)), (2200, 2204, (16, 17, 18, 19)),
)
# Calling codes of one and two digits, and the first two digits of those of three.
_CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_CALLING_3 = frozenset("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())
# How keys of public services begin.
_KEY_STARTS = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk-", "sk_live_", "sk_test_", "pk_live_", "rk_live_", "xoxb-", "xoxp-", "eyJ", "npm_", "pypi-", "SG.", "ya29")
_UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)


def _issued(digits: str) -> bool:
    """Whether an issuer has numbers of this beginning and length."""
    return any(len(digits) in lengths and low <= int(digits[: len(str(low))]) <= high for low, high, lengths in _ISSUERS)


def _called(digits: str) -> bool:
    return digits[:1] in _CALLING or digits[:2] in _CALLING or digits[:2] in _CALLING_3


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the looser patterns that touch no base span (``base`` is sorted) and no other candidate."""
    found: list[tuple[int, int, int]] = []
    if _MARK.search(text):
        found += [(m.start(), EMAIL, m.end()) for m in _MARKED_AT.finditer(text)]
    if _DIGIT.search(text):
        found += [(m.start(), IP, m.end()) for m in _TEXT_ADDRESS.finditer(text)] if "[.]" in text else []
        found += [(m.start(), CARD, m.end()) for m in _ODD_CARD.finditer(text)]
        found += [(m.start(), PHONE, m.end()) for pattern in (_NATIONAL, _GROUPED) for m in pattern.finditer(text)]
        # Runs of a card's length whose checksum fails.
        for m in _DIGITS.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(digits := _only_digits(m.group())) <= 19 and not luhn(digits):
                if not (m.start() and text[m.start() - 1].isalnum() or m.end() < len(text) and text[m.end()].isalnum()):
                    found.append((m.start(), CARD, m.end()))
        found += [(m.start(), SECRET, m.end()) for m in _LONG_TOKEN.finditer(text) if _DIGIT.search(m.group()) and _LETTER.search(m.group())]
    if not found:
        return []
    starts, kept = [a for a, _, _ in base], []
    reach = list(itertools.accumulate((b for _, _, b in base), max))  # the furthest end of the base spans up to each
    for a, kind, b in sorted(found):
        before = bisect.bisect_left(starts, b)
        if not (before and reach[before - 1] > a) and (not kept or kept[-1][2] <= a):
            kept.append((a, kind, b))
    return kept


# Votes -----------------------------------------------------------------------------------------------

_STRICT = (
    re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    re.compile(r"[0-9]{13,19}|[0-9]{4}(?:([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})"),
    re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{1,5}\)?(?:[ .-]?[0-9]{2,5}){1,4}"),
    re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}|(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])[A-Za-z0-9+/_-]{24,}={0,2}"),
)
_WORD = re.compile(r"[^\W\d_][\w-]*", re.U)


def votes(text: str, span: tuple[int, int, int]) -> tuple[int, ...]:
    """A vote of each labeler on a span: 1 yes, -1 no, 0 none."""
    start, kind, end = span
    value, left = text[start:end], text[max(0, start - 40) : start].lower()
    digits = _only_digits(value)
    shape = 1 if _STRICT[kind].fullmatch(value) else 0
    words = _WORD.findall(left)[-3:]
    context = 1 if any(w in _ANNOUNCE[kind] for w in words) else -1 if any(w in _AGAINST[kind] for w in words) else 0
    if end < len(text) and text[end].isalnum() or start and text[start - 1].isalnum():
        context = -1
    if kind == EMAIL:
        ending = re.split(r"[^A-Za-z]+", value.lower().rstrip("-."))[-1]
        known = 1 if ending in _ENDINGS or len(ending) == 2 else -1 if ending in _NO_ENDINGS else 0
        return shape, known, context, 1 if 6 <= len(value) <= 254 else -1
    if kind == IP:
        return shape, -1 if value.startswith(_NO_HOST) else 1, context, 1 if all(_octet(p) for p in _PART.findall(value)) else -1
    if kind == CARD:
        return shape, 1 if _issued(digits) else -1, context, 1 if luhn(digits) else -1
    if kind == SECRET:
        parts = re.split(r"[/_+-]", value)
        plain = len(parts) > 2 and all(p.isdigit() or p.islower() and p.isalpha() for p in parts if p)
        known = 1 if value.startswith(_KEY_STARTS) else -1 if plain or _UUID.fullmatch(value) else 0
        kinds, given = len(set(value.lower())), text[max(0, start - 2) : start].rstrip(" ")[-1:] in ("=", ":", '"', "'", "`")
        return shape, known, context, -1 if kinds < 9 else 1 if given else 0
    known = _called(digits) if value[0] == "+" else value[:2] in ("00", "(0")
    return shape, 1 if known else -1 if value[0] == "+" else 0, context, 1 if 9 <= len(digits) <= 15 and len(set(digits)) > 2 else -1


def _features(text: str, span: tuple[int, int, int]) -> tuple[int, ...]:
    """Features of the classifier: separators, brackets, a letter next to the span, long digit runs."""
    start, _, end = span
    value = text[start:end]
    return (
        int(any(c in " -/" for c in value)), int("(" in value or "[" in value),
        int(start > 0 and text[start - 1].isalnum() or end < len(text) and text[end].isalnum()),
        int(bool(re.search(r"[0-9]{7}", value))),
    )


# The model -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Reliabilities ``P(vote | label)`` of each labeler, and weights of the classifier, by kind."""

    reliability: np.ndarray
    weights: np.ndarray

    def likelihood(self, kind: int, vote: tuple[int, ...], features: tuple[int, ...]) -> float:
        return float(1 / (1 + math.exp(-float(np.dot(self.weights[kind], _inputs(vote, features))))))


#: P(vote -1, 1 | label, given a vote) before any data, for the labels no and yes; a 0 is no evidence.
_START = np.array([[0.8, 0.2], [0.2, 0.8]])


def _inputs(vote: tuple[int, ...], features: tuple[int, ...]) -> np.ndarray:
    return np.array([1.0, *[float(v == 1) for v in vote], *[float(v == -1) for v in vote], *features])


def estimate(patterns: dict[tuple, int], rounds: int = 50) -> Model:
    """Expectation-maximisation over counted patterns ``(kind, votes, features)``, then logistic regression on its posteriors.

    A kind without spans keeps the starting reliabilities: labelers are right three times in four.
    """
    labelers, width = len(LABELERS), 1 + 2 * len(LABELERS) + 4
    reliability = np.tile(_START, (len(ALL_KINDS), labelers, 1, 1))
    weights = np.zeros((len(ALL_KINDS), width))
    for kind in range(len(ALL_KINDS)):
        own = sorted((p, n) for p, n in patterns.items() if p[0] == kind)
        theta = np.tile(_START, (labelers, 1, 1))
        v = np.array([p[1] for p, _ in own], int).reshape(-1, labelers)
        n = np.array([c for _, c in own], float)
        prior, posterior = 0.5, np.zeros(len(own))
        for _ in range(rounds if own else 0):
            logs = np.stack([sum(np.where(v[:, k] == 0, 0, np.log(theta[k, label, (v[:, k] > 0) * 1])) for k in range(labelers)) for label in (0, 1)])
            logs += np.log([[1 - prior], [prior]])
            posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
            prior = float(np.clip((n * posterior).sum() / n.sum(), 0.01, 0.99))
            for k in range(labelers):
                for label, share in ((0, 1 - posterior), (1, posterior)):
                    cast = v[:, k] != 0
                    counts = np.bincount((v[cast, k] > 0) * 1, weights=(n * share)[cast], minlength=2) + 5 * _START[label]
                    theta[k, label] = counts / counts.sum()
        reliability[kind] = theta
        # Every vote pattern counts a little even where the data lack it, so that the classifier knows what votes mean.
        x = [_inputs(p[1], p[2]) for p, _ in own] + [_inputs(vote, (0, 0, 0, 0)) for vote in _all_votes()]
        prior_label = [_vote_posterior(theta, vote) for vote in _all_votes()]
        y = np.concatenate([posterior, prior_label])
        w = np.concatenate([n / max(1.0, n.sum()) * 81, np.ones(len(prior_label))])
        weights[kind] = _logistic(np.array(x), y, w)
    return Model(reliability, weights)


def _all_votes() -> list[tuple[int, ...]]:
    return [(a, b, c, d) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) for d in (-1, 0, 1)]


def _vote_posterior(theta: np.ndarray, vote: tuple[int, ...]) -> float:
    odds = sum(math.log(theta[k, 1, int(v > 0)] / theta[k, 0, int(v > 0)]) for k, v in enumerate(vote) if v)
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 30, ridge: float = 0.5) -> np.ndarray:
    """Weighted logistic regression on soft labels by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(hessian, x.T @ (w * (y - p)) - ridge * beta)
    return beta


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Estimate the model from all texts. Only counts of patterns reach the driver: at most a few thousand rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in text_slices(batches):
            for x in batch.column(0):
                value = x.as_py()
                if value:
                    base = base_spans(value)
                    for span in base + candidates(value, base):
                        seen[(span[1], *votes(value, span), *_features(value, span))] += 1
        patterns = [",".join(map(str, p)) for p in seen]
        yield pa.RecordBatch.from_pydict({"pattern": pa.array(patterns, pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    rows = docs.select(text).mapInArrow(count, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    parsed = {tuple(map(int, r["pattern"].split(","))): r["n"] for r in rows}
    return estimate({(p[0], p[1:5], p[5:]): n for p, n in parsed.items()})


def all_spans(text: str, model: Model, threshold: float = THRESHOLD) -> tuple[list, list]:
    """Base spans, and all spans: those and the candidates that the classifier accepts."""
    base = base_spans(text)
    more = [s for s in candidates(text, base) if model.likelihood(s[1], votes(text, s), _features(text, s)) >= threshold]
    return base, sorted(base + more) if more else base


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans, the digest of their list, and the list of all spans, for every row.

    A null or empty text has no spans: counts of 0, the digest of the empty string, an empty list.
    Spans count code points, the end is exclusive; they are sorted by start, then kind (``ALL_KINDS``). Repeated
    rows each get a row; an empty table gives an empty one.
    """

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"doc_id": batch.column(0), "n_email": [], "n_ip": [], "n_card": [], "n_phone": [], "base_sha256": [], "spans": []}
        for x in batch.column(1):
            base, spans = all_spans(x.as_py() or "", model)
            kinds = Counter(s[1] for s in base)
            for k, name in enumerate(KINDS):
                out[f"n_{name}"].append(kinds[k])
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(spans))
        return out

    columns = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text)), run, columns)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, of the first kind."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{ALL_KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: Model, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in ``text``, and ``length`` (if there is such a column) counted anew for changed texts."""
    fields, kinds = docs.columns, dict(docs.dtypes)
    at = fields.index(text)
    counted = fields.index(length) if length in fields and kinds[length] in ("int", "bigint") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = batch.column(at).to_pylist()
            new = [masked(t, s) if t and (s := all_spans(t, model)[1]) else t for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if counted is not None:
                lengths = columns[counted].to_pylist()
                lengths = [n if a is b else len(b) for n, a, b in zip(lengths, texts, new, strict=True)]
                columns[counted] = pa.array(lengths, batch.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)

