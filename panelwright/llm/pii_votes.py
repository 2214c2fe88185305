"""Personal data by weak supervision (operator 10).

Base spans come from four fixed patterns and always stay. Besides, wider patterns propose
candidates (numbers grouped in other ways, written-out addresses). For every span, labelers
vote yes, no or nothing: the shape of the match (pattern labelers), known endings, prefixes
and exchanges (gazetteer labelers), words in front of it (context labelers). Per kind,
expectation-maximisation over the vote patterns estimates how reliable each labeler is, and
from that a probability for each pattern; a logistic span classifier is trained on these
soft labels with votes and shape as features, and decides which candidates are added.

The votes of all documents are counted by Spark (kind x pattern x shape: a few thousand
combinations at most, whatever the input), and only these counts reach the driver. They enter as
shares, beside a fixed belief in each labeler: how large a table is does not decide about a span.

Defined results: a null text counts as empty and has no spans. Scanning takes time in proportion to the
text, long runs without blanks too. A number of 13 digits or more that fails the Luhn check is no candidate. Offsets are code points, end
exclusive. Added spans never overlap a base span or one another. n_* and base_sha256 speak of
base spans alone; spans lists all. Repeated rows give repeated results, an empty table none.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import pieces, stage

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.8  # probability from which a candidate is added
ROUNDS = 50
TRUST = 40.0  # spans that the belief in a labeler weighs
MASS = 40.0  # and all spans of a table together, however many there are
_REACH = 40  # code points of context before a span

# Whether a run of signs belongs to a match hangs on what follows the run, not on where in it the match begins. So
# a match begins at the start of its run (or where the one before ended), and runs are never given back: linear in the text.
_ADDRESS = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_EMAIL, _NEXT_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + _ADDRESS), re.compile(_ADDRESS)
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WIDE_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?(?:at|@) ?[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]++)++", re.I
)
_WIDE_NUMBER = re.compile(r"(?<![0-9A-Za-z.+-])[(0-9](?:[ ().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z]|[.-][0-9])")
_CUES = {
    "email": re.compile(r"mail|contact|write|schreib|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|adresse", re.I),
    "card": re.compile(r"card|visa|karte|carte|tarjeta|pay|zahl", re.I),
    "phone": re.compile(r"phone|call|tel|mobil|fax|anruf|appel|llam", re.I),
}
_COUNTER_CUE = re.compile(r"version|isbn|order|page|figure|token|key|secret|nr\.|no\.", re.I)
_ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu"}
_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "22", "23", "24", "25", "26", "27")
LABELERS = ("shape", "check", "gazetteer", "cue", "counter cue", "break")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    m = _EMAIL.search(text)
    while m:
        yield m.span()
        m = _NEXT_EMAIL.match(text, m.end()) or _EMAIL.search(text, m.end())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns, leftmost and non-overlapping per kind; failing matches are dropped."""
    out = []
    if "@" in text:
        out += [("email", *span) for span in _emails(text)]
    parts = lambda m: [p.lstrip("0") for p in m[0].split(".")]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts(m))]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """What the wider patterns propose beside the base spans."""
    taken = sorted((s, e) for _, s, e in base)
    starts, reach, far = [s for s, _ in taken], [], 0
    for _, e in taken:
        far = max(far, e)
        reach.append(far)
    wide = [("email", m) for m in _WIDE_EMAIL.finditer(text)] if "(" in text or "[" in text else []
    for m in _WIDE_NUMBER.finditer(text):
        digits = _digits(m[0])
        if len(digits) < 13:
            wide.append(("phone", m))
        elif luhn(digits):  # a number that fails the check is no card, whatever stands around it
            wide.append(("card", m))
    out: list[tuple[str, int, int]] = []
    last = 0
    for kind, m in sorted(wide, key=lambda x: (x[1].start(), x[0])):
        s, e = m.span()
        before = bisect_left(starts, e)  # base spans that begin before this one ends
        if s >= last and (not before or reach[before - 1] <= s):
            out.append((kind, s, e))
            last = e
    return out


def votes(text: str, kind: str, s: int, e: int) -> tuple[int, ...]:
    """Of each labeler: 2 yes, 1 no, 0 nothing."""
    span, digits = text[s:e], _digits(text[s:e])
    before = text[max(0, s - _REACH) : s]
    groups = re.split(r"[^0-9]+", span.strip("+() "))
    if kind == "email":
        shape = 2 if "@" in span else 0
        check = 2 if re.search(r"[A-Za-z]{2,}$", span) else 1
        known = 2 if span.rsplit(".", 1)[-1].lower() in _ENDINGS else 0
    elif kind == "ip":
        shape = 2 if all(len(p) <= 3 for p in span.split(".")) else 1
        check = 1 if any(len(p) > 1 and p[0] == "0" for p in span.split(".")) else 2
        known = 1 if span.startswith(("0.", "127.", "255.")) else 0
    elif kind == "card":
        shape = 2 if [len(g) for g in groups] in ([16], [4, 4, 4, 4], [15], [4, 6, 5]) else 1
        check = 2 if luhn(digits) else 1
        known = 2 if digits.startswith(_ISSUERS) else 1
    else:
        shape = 2 if span.startswith("+") or re.fullmatch(r"\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}", span) else 1
        check = 2 if len(groups) > 1 and all(len(g) >= 1 for g in groups) else 1
        known = 2 if "555" in groups or span.startswith(("+1", "+33", "+34", "+49", "+44")) else 0
    cue = 2 if _CUES[kind].search(before) else 0
    counter = 1 if _COUNTER_CUE.search(before) else 0
    edge = 2 if (s == 0 or text[s - 1].isspace()) and (e == len(text) or not text[e].isalnum()) else 1
    return shape, check, known, cue, counter, edge


def _pattern(v: tuple[int, ...]) -> int:
    code = 0
    for x in v:
        code = 3 * code + x
    return code


def _unpack(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        out.append(code % 3)
        code //= 3
    return out[::-1]


def _shape_class(kind: str, span: str) -> int:
    """A few classes of length and of separators."""
    return min(4, len(_digits(span)) // 4) * 4 + (" " in span) * 2 + ("-" in span or "." in span)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("s", pa.int64()), ("e", pa.int64()), ("base", pa.bool_()), ("votes", pa.int32()), ("shape", pa.int32())]))
    interesting = re.compile(r"[0-9@]|[\[(] ?at ?[\])]", re.I)
    for batch in batches:
        for part in pieces(batch):
            out = []
            for text in part.column("text").to_pylist():
                found: list[dict] = []
                if text and interesting.search(text):
                    base = base_spans(text)
                    for k, s, e in [*base, *candidates(text, base)]:
                        found.append(
                            {"kind": KINDS.index(k), "s": s, "e": e, "base": len(found) < len(base),
                             "votes": _pattern(votes(text, k, s, e)), "shape": _shape_class(k, text[s:e])}
                        )
                out.append(found)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])


_SPANS = "spans array<struct<kind: int, s: bigint, e: bigint, base: boolean, votes: int, shape: int>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and every base span and candidate with its votes and shape."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id {kind}, {_SPANS}")


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, trust: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns (n x labelers): P(vote | not, yes) per labeler, and P(yes) per pattern.

    It starts from the belief that a labeler which says something is right five times of six, which weighs
    as ``trust`` spans throughout.
    """
    belief = np.empty((2, patterns.shape[1], 3))
    belief[0], belief[1] = (0.4, 0.5, 0.1), (0.4, 0.1, 0.5)
    table, prior = belief, np.array([0.5, 0.5])
    for _ in range(rounds):
        odds = np.log(prior[1] / prior[0]) + sum(
            np.log(table[1, j, patterns[:, j]] / table[0, j, patterns[:, j]]) for j in range(patterns.shape[1])
        )
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        weight = np.stack([counts * (1 - p), counts * p])
        table = trust * belief
        for v in range(3):
            table[:, :, v] += weight @ (patterns == v)
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + trust / 2) / (weight.sum() + trust)
    return table, p


def classifier(features: np.ndarray, target: np.ndarray, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Logistic regression on soft targets, ridge, by gradient with momentum; the last weight is the bias."""
    x = np.c_[features, np.ones(len(features))]
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    share = counts / counts.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        speed = 0.9 * speed - 0.5 * (x.T @ (share * (p - target)) + 1e-3 * w)
        w = w + speed
    return w


def _features(code: int, shape: int) -> np.ndarray:
    v = np.array(_unpack(code))
    return np.r_[v == 1, v == 2, np.arange(20) == shape].astype(float)


def fit(counted: list[tuple[int, int, int, int]]) -> dict[tuple[int, int, int], float]:
    """From counts of (kind, votes, shape): the probability that such a span is personal data."""
    out = {}
    for k in range(len(KINDS)):
        rows = sorted(r for r in counted if r[0] == k)
        if not rows:
            continue
        patterns = np.array([_unpack(r[1]) for r in rows])
        counts = np.array([r[3] for r in rows], float)
        # A table and the same table a thousand times over give the same probabilities.
        _, soft = reliabilities(patterns, MASS * counts / counts.sum(), trust=TRUST)
        x = np.array([_features(r[1], r[2]) for r in rows])
        w = classifier(x, soft, counts)
        p = 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ w, -30, 30)))
        out |= {r[:3]: float(q) for r, q in zip(rows, p)}
    return out


def _decide(model: dict[tuple[int, int, int], float], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for found in batch.column("spans").to_pylist():
                base = [(KINDS[x["kind"]], x["s"], x["e"]) for x in found if x["base"]]
                more = [
                    (KINDS[x["kind"]], x["s"], x["e"])
                    for x in found
                    if not x["base"] and model.get((x["kind"], x["votes"], x["shape"]), 0.0) >= threshold
                ]
                n = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append([*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined([*base, *more])])
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return run


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = stage(scan(docs), "spans")
    each = found.select(F.inline("spans"))
    counted = each.groupBy("kind", "votes", "shape").agg(F.count("*").alias("n")).collect()  # 4 x 729 x 20 at most
    model = fit([tuple(r) for r in counted])
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return found.mapInArrow(_decide(model, threshold), f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def mask(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in brackets."""
    listed = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x))
    out, at = [], 0
    for s, e, k in listed:
        if e > at:
            out += [text[at : max(at, s)], f"[{k}]"]
            at = e
    return "".join([*out, text[at:]])
