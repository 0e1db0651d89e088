"""Personal data by weak supervision: labelers vote on candidate spans, a classifier learns from their weighed votes.

Candidates of each kind (email, ip, card, phone) are the matches of the base
patterns, the matches that fail the base checks, and looser forms: addresses
written with ``(at)`` and ``dot``, defanged or IPv6 addresses, cards with other
separators, phone numbers without a plus sign. Regex, gazetteer and context
labelers vote for, against or not at all. Votes are counted by pattern over all
candidates of all documents; expectation-maximisation on the counts estimates
how often each labeler is right (its vote given the truth) without any labels.
The posterior of a candidate's votes is its soft label, and a logistic span
classifier over the votes, shape and neighbouring words learns from the soft
labels of at most ``sample_rows`` candidates in a fixed hash order.

Base matches always stay. A candidate that the classifier gives ``threshold`` or
more is added if it overlaps no base span and no better added one.

Every text is read once, whole; candidates with their votes are stored. The
driver sees vote pattern counts (3 to the number of labelers a kind, at most),
the sample, and the classifier's weights. The patterns are matched in time
linear in the text, whatever it holds.

Defined results: null and empty texts have no spans; null ids pass through;
repeated rows have equal spans; places count code points, ends exclusive; extra
columns are ignored; an empty table gives an empty result; with no candidates of
a kind its labelers keep their prior reliabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 20_000
THRESHOLD = 0.9
#: Looser forms are at most so long.
LOOSE_LENGTH = 48

LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Possessive and begun at its head only, so a chain of numbers is read once; four parts at a time are an address.
CHAIN = re.compile(r"(?<![0-9])(?<![0-9]\.)[0-9]++(?:\.[0-9]++){3,}+")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WRITTEN_AT = re.compile(r"\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?|\x20(?:at|AT)\x20(?=[A-Za-z0-9-]{1,63}(?:\x20(?:dot|DOT)\x20|\.)[A-Za-z0-9])")
WRITTEN_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?(?:dot|DOT|\.)\x20?[\])}]\x20?|\x20(?:dot|DOT)\x20)[A-Za-z0-9-]{1,63}){1,6}")
CHUNK = re.compile(r"\(?[0-9][0-9\x20()./_\[\]-]*[0-9]")
COLONS = re.compile(r"(?::[0-9A-Fa-f]{1,4}){7}(?![:0-9A-Fa-f])")
LOOSE_PHONE = re.compile(r"(?:00[1-9][0-9]{0,2}[\x20.-])?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}")
LOOSE_CARD = re.compile(r"[0-9]{4}(?:[./_]|\x20\x20|\x20-\x20)[0-9]{4}(?:(?:[./_]|\x20\x20|\x20-\x20)[0-9]{1,7}){1,3}")
LOOSE_IP = re.compile(r"[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}){3}")

#: Gazetteers.
DOMAINS = frozenset("com org net edu gov mil int info biz io co de fr es uk us ca au it nl ch at be eu ru cn jp br in pl se no fi dk pt cz".split())
FILE_ENDS = frozenset("png jpg jpeg gif svg css js json html htm php py txt pdf zip gz md xml".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|38|30")
SPECIAL_ADDRESSES = re.compile(r"(?:0|127|255)\.|(?:[0-9]\.){3}[0-9]\Z")

NEAR_WORDS = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|reach|correo|courriel|kontakt|address)\b", re.I),
    "ip": re.compile(r"\b(?:ip|ipv[46]|host|server|addr(?:ess)?|login|logged|client|connect(?:ed|ion)?|ping|dirección|adresse)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment|paid|karte|tarjeta|carte)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax|ring|dial|teléfono|telefon|téléphone|whatsapp|sms)\b", re.I),
}
OTHER_WORDS = re.compile(r"\b(?:version|release|isbn|issn|doi|order|invoice|article|section|figure|table|chapter|page|pp|vol|ref|id|serial|commit|build|sku|patent|score)\b", re.I)
LABELERS = ("base pattern", "checks", "gazetteer", "words before", "words after", "edges", "digits", "separators")

#: Hashed features of the classifier, beside kind by vote.
SHAPES, WORDS = 512, 512
WIDTH = len(KINDS) * (1 + 2 * len(LABELERS)) + SHAPES + 2 * WORDS


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2]))) % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def passes(kind: str, text: str) -> bool:
    """The check of a match: octets, card digits, phone digits."""
    if kind == "ip":
        return ":" in text or all(map(part_fits, re.findall(r"[0-9]+", text)))
    if kind == "card":
        digits = only_digits(text)
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(only_digits(text)) <= 15


def patterned(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of the base patterns, before their checks."""
    at, done = text.find("@"), 0
    while at >= 0:
        # The local part is the whole run before the sign; a run holds no sign, so nothing is read twice.
        begin = at
        while begin > done:
            m = LOCAL_END.search(text, max(done, begin - 256), begin)
            begin, full = (m.start(), m.start() == max(done, begin - 256)) if m else (begin, False)
            if not full:
                break
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield "email", begin, done
        at = text.find("@", max(at + 1, done))
    for m in CHAIN.finditer(text):
        parts = [p.span() for p in re.finditer(r"[0-9]+", m.group())]
        for i in range(0, len(parts) - 3, 4):
            yield "ip", m.start() + parts[i][0], m.start() + parts[i + 3][1]
    for m in DIGITS.finditer(text):
        yield "card", *m.span()
    for m in PHONE.finditer(text):
        yield "phone", *m.span()


def loose(text: str) -> Iterator[tuple[str, int, int]]:
    """Looser forms, some of which the base patterns match as well."""
    for m in WRITTEN_AT.finditer(text):
        local = LOCAL_END.search(text, max(0, m.start() - 64), m.start())
        domain = WRITTEN_DOMAIN.match(text, m.end())
        if local and domain:
            yield "email", local.start(), domain.end()
    for m in COLONS.finditer(text):
        head = re.search(r"[0-9A-Fa-f]{1,4}\Z", text[max(0, m.start() - 4) : m.start()])
        if head:
            yield "ip", m.start() - len(head.group()), m.end()
    for m in CHUNK.finditer(text):
        if m.end() - m.start() >= 7:
            for kind, form in (("phone", LOOSE_PHONE), ("card", LOOSE_CARD), ("ip", LOOSE_IP)):
                for own in form.finditer(text, *m.span()):
                    yield kind, *own.span()


def votes(kind: str, text: str, begin: int, end: int, base: bool) -> list[int]:
    """One vote a labeler: 1 for, -1 against, 0 none."""
    span, before, after = text[begin:end], text[max(0, begin - 40) : begin], text[end : end + 24]
    digits = only_digits(span)
    fits = passes(kind, span)
    known = 0
    if kind == "email":
        last = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        known = 1 if last in DOMAINS else -1 if last in FILE_ENDS else 0
    elif kind == "ip":
        known = -1 if SPECIAL_ADDRESSES.match(span) else 0
    elif kind == "card":
        known = 1 if ISSUERS.match(digits) else 0
    elif span[0] == "+" or span.startswith("00"):
        code = digits.removeprefix("00")
        known = 1 if any(code[:k] in CALLING_CODES for k in (1, 2, 3)) else -1

    def context(part: str) -> int:
        return 1 if NEAR_WORDS[kind].search(part) else -1 if OTHER_WORDS.search(part) else 0

    left, right = text[begin - 1 : begin] if begin else "", text[end : end + 1]
    joined = any(c.isalnum() or c in "_/=#\\@+" for c in (left, right) if c)
    runs = [len(list(g)) for _, g in groupby(digits)]
    plain = kind != "email" and bool(runs) and (max(runs) * 2 > len(digits) or digits in "01234567890123456789")
    marks = {c for c in span if not c.isalnum()}
    mixed = kind in ("card", "phone") and len(marks - set("()+")) > (1 if kind == "card" else 2)
    return [
        1 if base else 0, 1 if fits else -1, known, context(before), context(after), -1 if joined else 1,
        -1 if plain else 0, -1 if mixed else 0 if kind in ("email", "ip") else 1 if marks else 0,
    ]


def hashed(word: str, width: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % width


def features(kind: str, text: str, begin: int, end: int, cast: list[int]) -> list[int]:
    """Places of the ones of a candidate's feature vector."""
    k = KINDS.index(kind)
    at = k * (1 + 2 * len(LABELERS))
    out = [at] + [at + 1 + 2 * i + (v > 0) for i, v in enumerate(cast) if v]
    shape = re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 9)}", re.sub(r"[A-Za-z]+", "a", text[begin:end]))
    start = len(KINDS) * (1 + 2 * len(LABELERS))
    out.append(start + hashed(f"{kind} {shape}", SHAPES))
    before, after = re.findall(r"\w+", text[max(0, begin - 24) : begin]), re.findall(r"\w+", text[end : end + 24])
    out.append(start + SHAPES + hashed(before[-1].lower() if before else "", WORDS))
    out.append(start + SHAPES + WORDS + hashed(after[0].lower() if after else "", WORDS))
    return out


def candidates_of(text: str) -> list[tuple[str, int, int, bool, int, list[int]]]:
    """(kind, start, end, base, votes, features) of every candidate; votes as digits to the base three."""
    found: dict[tuple[str, int, int], bool] = {}
    for kind, begin, end in patterned(text):
        if kind != "card" or end - begin >= 7:  # short numbers are no candidates
            found[kind, begin, end] = passes(kind, text[begin:end])
    for kind, begin, end in loose(text):
        if end - begin <= LOOSE_LENGTH:
            found.setdefault((kind, begin, end), False)
    out = []
    for (kind, begin, end), base in sorted(found.items(), key=lambda c: (KINDS.index(c[0][0]), *c[0][1:])):
        cast = votes(kind, text, begin, end, base)
        code = 0
        for v in cast:
            code = 3 * code + v + 1
        out.append((kind, begin, end, base, code, features(kind, text, begin, end, cast)))
    return out


CANDIDATE = "array<struct<kind:string,start:int,end:int,base:boolean,votes:int,features:array<int>>>"
CANDIDATE_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.int32()), ("features", pa.list_(pa.int32()))])
)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the candidates of each row."""
    names = [f.name for f in CANDIDATE_TYPE.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[dict(zip(names, c, strict=True)) for c in candidates_of(t)] for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, CANDIDATE_TYPE)], ["doc_id", "candidates"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("_text")).mapInArrow(run, f"doc_id {kind}, candidates {CANDIDATE}")


class LabelModel:
    """Vote probabilities of each labeler given the truth, estimated by expectation-maximisation on pattern counts."""

    #: Pseudo counts of the votes (against, none, for) of a labeler when the span is no personal data, and when it is.
    PRIOR = np.array([[4.0, 3.0, 1.0], [1.0, 3.0, 4.0]])

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> None:
        labelers = patterns.shape[1]
        self.share = 0.5
        self.reliability = np.repeat((self.PRIOR / self.PRIOR.sum(axis=1, keepdims=True))[:, None], labelers, axis=1)
        if not len(patterns):
            return
        hot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
        before = self.posterior(patterns)
        for _ in range(steps):
            weight = np.stack([counts * (1 - before), counts * before])
            self.share = float(np.clip((weight[1].sum() + 1) / (counts.sum() + 2), 0.001, 0.999))
            votes = np.einsum("yp,plv->ylv", weight, hot) + self.PRIOR[:, None]
            self.reliability = votes / votes.sum(axis=2, keepdims=True)
            after = self.posterior(patterns)
            moved, before = np.abs(after - before).max(), after
            if moved < 1e-6:
                break

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a span with these votes is personal data."""
        each = np.log(self.reliability)[:, np.arange(patterns.shape[1]), patterns + 1].sum(axis=2)
        odds = each[1] - each[0] + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def decoded(codes: np.ndarray) -> np.ndarray:
    """Votes from their numbers to the base three."""
    powers = 3 ** np.arange(len(LABELERS) - 1, -1, -1)
    return (codes[:, None] // powers % 3 - 1).astype(np.int64)


def label_models(found: DataFrame) -> dict[str, LabelModel]:
    """A label model a kind, from the vote pattern counts of all candidates."""
    cast = found.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes").agg(F.count(F.lit(1)).alias("n")).toPandas()
    out = {}
    for kind in KINDS:
        own = cast[cast["kind"] == kind].sort_values("votes")
        out[kind] = LabelModel(decoded(own["votes"].to_numpy()), own["n"].to_numpy().astype(float))
    return out


def span_classifier(places: list[list[int]], soft: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a logistic function fitted to soft labels; equal rows are counted together."""
    weights = np.zeros(WIDTH)
    if not places:
        return weights
    rows: dict[tuple[int, ...], list[float]] = {}
    for own, p in zip(places, soft, strict=True):
        total = rows.setdefault(tuple(own), [0.0, 0.0])
        total[0] += 1
        total[1] += p
    used = sorted({i for row in rows for i in row})
    at = {i: k for k, i in enumerate(used)}
    x = np.zeros((len(rows), len(used)), dtype=np.float32)
    for r, row in enumerate(rows):
        x[r, [at[i] for i in row]] = 1
    n, target = np.array(list(rows.values())).T
    w = np.zeros(len(used))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (n * p - target) + ridge * w
        curvature = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(used))
        step = np.linalg.solve(curvature, gradient)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    weights[used] = w
    return weights


SPAN = "array<struct<kind:string,start:int,end:int,base:boolean,probability:double>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("probability", pa.float64())]))


def chosen(own: list[dict], weights: np.ndarray, threshold: float) -> list[dict]:
    """The base spans and the added ones, by kind, then start."""
    scored = []
    for c in own:
        p = float(1 / (1 + np.exp(-np.clip(weights[c["features"]].sum(), -40, 40))))
        scored.append({"kind": c["kind"], "start": c["start"], "end": c["end"], "base": c["base"], "probability": p})
    out = [s for s in scored if s["base"]]
    more = [s for s in scored if not s["base"] and s["probability"] >= threshold]
    for s in sorted(more, key=lambda s: (-s["probability"], s["start"] - s["end"], s["start"], s["kind"])):
        if all(s["end"] <= o["start"] or o["end"] <= s["start"] for o in out):
            out.append(s)
    return sorted(out, key=lambda s: (KINDS.index(s["kind"]), s["start"]))


def pii_spans(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and spans (kind, start, end, base, probability) of each row."""
    found = stored(candidates(docs), "candidates")
    models = label_models(found)
    each = found.select("doc_id", F.explode("candidates").alias("c")).select("doc_id", "c.*")
    order = (F.xxhash64("doc_id", "kind", "start", "end", "votes", "features"), "votes", "features")
    sample = each.orderBy(*order).limit(sample_rows).select("kind", "votes", "features").toPandas()
    soft = np.zeros(len(sample))
    for kind, model in models.items():
        at = np.flatnonzero(sample["kind"] == kind)
        if len(at):
            soft[at] = model.posterior(decoded(sample["votes"].to_numpy()[at]))
    weights = span_classifier([list(f) for f in sample["features"]], soft)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [chosen(own, weights, threshold) for own in batch.column("candidates").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, SPAN_TYPE)], ["doc_id", "spans"])

    return found.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPAN}")


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base spans, their digest, and all spans."""

    def written(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def counted(kind):
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    rows = pii_spans(docs).withColumn("_base", F.filter("spans", lambda s: s["base"]))
    counts = [counted(kind) for kind in KINDS]
    return rows.select("doc_id", *counts, F.sha2(written(F.col("_base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
