"""Language identification in two steps: the family first, then the language within it.

Texts are vectors of relative frequencies of hashed byte n-grams. A linear
support vector machine per family tells it from the rest; within the family
chosen, one machine for each pair of its languages votes. A text whose n-grams
are less likely in the learned languages than those of nearly all learned text
of its length is in none of them; the marks are calibrated on sampled texts that
are kept from counting. Under 8 bytes nothing is rejected so.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import mixed, trim, utf8
from rillstone.session import stage

# Language families, by the codes of ISO 639-1; any other language is a family of its own.
FAMILIES = {
    "germanic": "da de en is nl no sv", "romance": "ca es fr gl it pt ro",
    "slavic": "bg cs hr mk pl ru sk sl sr uk", "uralic": "et fi hu",
}
SIZES = (1, 2, 3, 4)  # bytes of an n-gram
SCALE = 20.0
UNKNOWN = "und"
LETTER = r"\p{L}"
KNOWN = "known"  # the one-class machine
LENGTHS = range(3, 13)  # binary logarithms of the lengths in bytes that have a mark
STRAYS = 0.002  # the share of learned text under the quantile that a mark starts from
SLACK = 0.35  # a mark lies so much further from the median than that quantile


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members.split()), f"only {language}")


class Grams:
    """Hashed byte n-grams of some texts, one size after the other."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, buckets: int):
        self.data, self.offsets = utf8(pc.utf8_lower(texts.cast(pa.large_string())))
        self.buckets = np.uint64(buckets - 1)
        lengths = np.diff(self.offsets)
        self.count = sum(np.maximum(lengths - n + 1, 0) for n in SIZES)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Codes at each byte, and which of them stay inside their text."""
        code = np.zeros(len(self.data), np.uint64)
        ends = np.zeros(len(self.data) + 1, np.int32)
        for n in range(1, max(SIZES) + 1):
            code = code[: len(self.data) - n + 1] * np.uint64(257) + self.data[n - 1 :].astype(np.uint64)
            if n > 1:  # the last byte of a text begins no longer n-gram
                np.add.at(ends, np.maximum(self.offsets[1:] - n + 1, self.offsets[:-1]), 1)
                np.add.at(ends, np.minimum(np.maximum(self.offsets[1:] - n + 2, self.offsets[:-1]),
                                           self.offsets[1:]), -1)
            if n in SIZES:
                yield (mixed(code + np.uint64(n << 48)) & self.buckets).astype(np.int64), np.cumsum(ends)[: len(code)] == 0

    def means(self, weights: np.ndarray) -> np.ndarray:
        """The mean weight of each text's n-grams, for every machine."""
        sums = np.zeros((len(self.offsets) - 1, weights.shape[1]))
        for codes, inside in self:
            for column in range(weights.shape[1]):
                running = np.zeros(len(self.data) + 1)
                np.cumsum(np.where(inside, weights[codes, column], 0), out=running[1 : len(codes) + 1])
                running[len(codes) + 1 :] = running[len(codes)]
                sums[:, column] += running[self.offsets[1:]] - running[self.offsets[:-1]]
        return sums / np.maximum(self.count, 1)[:, None]

    def vectors(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's distinct codes and their relative frequencies."""
        found: list[list[np.ndarray]] = [[] for _ in self.count]
        for codes, inside in self:
            for doc, (a, b) in enumerate(zip(self.offsets[:-1], np.minimum(self.offsets[1:], len(codes)), strict=True)):
                if b > a:
                    found[doc].append(codes[a:b][inside[a:b]])
        out = []
        for doc, parts in enumerate(found):
            codes, counts = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
            out.append((codes.astype(np.int32), (counts / max(self.count[doc], 1)).astype(np.float32)))
        return out


def train(vectors: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, buckets: int,
          cost: float = 10.0, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Weights, and last the bias, of a linear support vector machine: dual coordinate descent on squared hinge loss."""
    weights, alpha = np.zeros(buckets + 1), np.zeros(len(vectors))
    # each side counts the same, however many examples it has
    share = {s: len(sign) / (2 * max(1, (sign == s).sum())) for s in (-1.0, 1.0)}
    slack = np.array([1 / (2 * cost * share[s]) for s in sign])
    norm = np.array([SCALE * SCALE * (v @ v) + 1 for _, v in vectors]) + slack
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(vectors)):
            codes, values = vectors[i]
            gap = sign[i] * (SCALE * (weights[codes] @ values) + weights[-1]) - 1 + slack[i] * alpha[i]
            new = max(0.0, alpha[i] - gap / norm[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weights[codes] += SCALE * step * values
                weights[-1] += step
                alpha[i] = new
    return weights.astype(np.float32)


def likely(texts: list[str], languages: list[str], buckets: int) -> np.ndarray:
    """Log chances of the buckets, the same weight for each language, and after them a mark for each of ``LENGTHS``.

    One text in four is kept from counting and cut into windows of each length;
    a length of which there are too few has the mark of the one before it.
    """
    counts = {x: np.zeros(buckets) for x in languages}
    kept = []
    for k, (text, language) in enumerate(zip(texts, languages, strict=True)):
        if k % 4 == 3:
            kept.append(text.encode())
            continue
        for codes, values in Grams(pa.array([text]), buckets).vectors():
            counts[language][codes] += values
    chances = sum(c / max(c.sum(), 1e-9) for c in counts.values()) / max(1, len(counts))
    weights = np.log(chances + 0.1 / buckets).astype(np.float32)
    marks, last = [], -np.inf
    for size in (1 << k for k in LENGTHS):
        found = [b[at : at + size].decode("utf-8", "ignore") for b in kept
                 for at in range(0, min(len(b) - size + 1, 20 * size), size)]
        found = [x for x in found if any(map(str.isalpha, x))]
        if len(found) >= 20:
            mean = np.concatenate([Grams(pa.array(found[at : at + 500]), buckets).means(weights[:, None])[:, 0]
                                   for at in range(0, len(found), 500)])
            low, middle = np.quantile(mean, [STRAYS, 0.5])
            last = low - SLACK * (middle - low)
        marks.append(last)
    return np.concatenate([weights, np.array(marks, np.float32)])


class Model:
    """The machines: a matrix of weights, one column each; the last is the one-class machine."""

    def __init__(self, languages: list[str], weights: dict[str, np.ndarray], buckets: int):
        self.languages, self.buckets = sorted(languages), buckets
        self.families = sorted({family_of(x) for x in self.languages})
        self.members = {f: [x for x in self.languages if family_of(x) == f] for f in self.families}
        self.names = list(machines(self.languages))
        columns = [weights[n] for n in self.names]
        matrix = np.stack(columns, 1) if columns else np.zeros((buckets + 1, 0), np.float32)
        none = np.concatenate([np.zeros(buckets, np.float32), np.full(len(LENGTHS), -np.inf, np.float32)])
        one = weights.get(KNOWN, none)
        self.marks = one[buckets:]
        self.weights = np.column_stack([matrix[:-1] * np.float32(SCALE), one[:buckets]])
        self.bias = np.append(matrix[-1], np.float32(0))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Each text's language, how sure that is, and whether it is likely in any language learned."""
        grams = Grams(texts, self.buckets)
        margin = grams.means(self.weights) + self.bias
        column = {n: margin[:, k] for k, n in enumerate(self.names)}
        sure = lambda m: 1 / (1 + np.exp(-2 * np.clip(m, -30, 30)))
        rows = len(grams.count)
        if len(self.families) == 2:
            one = column[f"family {self.families[0]}"]
            of_family = np.stack([one, -one], 1)
        elif len(self.families) > 2:
            of_family = np.stack([column[f"family {f}"] for f in self.families], 1)
        else:
            of_family = np.full((rows, len(self.families)), 30.0)
        language, score = np.full(rows, UNKNOWN, object), np.zeros(rows)
        if not self.families:
            return language.tolist(), score, np.zeros(rows, bool)
        best = of_family.argmax(1)
        for k, family in enumerate(self.families):
            here = np.flatnonzero(best == k)
            members = self.members[family]
            votes, least = np.zeros((len(here), len(members))), np.full((len(here), len(members)), 30.0)
            for a, b in combinations(range(len(members)), 2):
                m = column[f"pair {members[a]} {members[b]}"][here]
                votes[:, a] += m >= 0
                votes[:, b] += m < 0
                least[:, a], least[:, b] = np.minimum(least[:, a], m), np.minimum(least[:, b], -m)
            # most votes; of equal ones the surer, then the first by name
            chosen = (votes + sure(least) / 2).argmax(1)
            language[here] = np.array(members, object)[chosen]
            score[here] = sure(of_family[here, k]) * sure(least[np.arange(len(here)), chosen])
        size = np.diff(grams.offsets)
        at = np.log2(np.maximum(size, 1)).astype(int) - LENGTHS[0]
        mark = np.where(at < 0, -np.inf, self.marks[np.clip(at, 0, len(self.marks) - 1)])
        known = margin[:, -1] >= mark  # too short a text tells too little and counts as known
        return language.tolist(), score, known


def machines(languages: list[str]) -> Iterator[str]:
    families = sorted({family_of(x) for x in languages})
    yield from (f"family {f}" for f in (families[:1] if len(families) == 2 else families if len(families) > 2 else []))
    for family in families:
        yield from (f"pair {a} {b}" for a, b in combinations(sorted(x for x in languages if family_of(x) == family), 2))


def _side(machine: str, language: str) -> float:
    kind, *names = machine.split(" ", 1)
    if kind == "family":
        return 1.0 if family_of(language) == names[0] else -1.0
    a, b = names[0].split(" ")
    return 1.0 if language == a else -1.0 if language == b else 0.0


def fit(
    labelled: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id",
    sample: int = 200, buckets: int = 1 << 15,
) -> Model:
    """Learn from a bounded sample: the ``sample`` texts of each language with the smallest hash of ``key`` and text.

    Each line of a sampled text is an example. One task trains one machine;
    the driver gets the machines' weights, whose size depends on the labels only.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(language).alias("language"),
                           F.xxhash64(F.col(key), F.col(text)).alias("rank"))
    rows = rows.filter("text is not null and language is not null").filter(F.col("text").rlike(LETTER))
    counts = {r[0]: r[1] for r in rows.groupBy("language").count().collect()}  # one row per language
    if not counts:
        return Model([], {}, buckets)
    near, spare = None, {name: 4 for name in counts}
    while True:
        # the smallest hashes lie under this mark, with plenty to spare, unless many rows are alike
        mark = F.lit(None).cast("long")
        for name, n in counts.items():
            under = min((1 << 63) - 1, -(1 << 63) + (spare[name] * sample << 64) // n)
            mark = F.when(F.col("language") == name, F.lit(under)).otherwise(mark)
        under_mark = rows.filter(F.col("rank") <= mark)
        first = Window.partitionBy("language").orderBy("rank", "text")
        near = stage(under_mark.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample))
        got = {r[0]: r[1] for r in near.groupBy("language").count().collect()}
        short = [name for name, n in counts.items() if got.get(name, 0) < min(sample, n)]
        if not short:
            break
        spare |= {name: 64 * spare[name] for name in short}
    names = list(machines(list(counts)))
    wanted = F.lit(None).cast("array<string>")
    for name in counts:
        mine = [m for m in names if _side(m, name)]
        wanted = F.when(F.col("language") == name, F.array(*map(F.lit, [*mine, KNOWN]))).otherwise(wanted)

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        machine = frame["machine"].iloc[0]
        frame = frame.sort_values(["rank", "text"])
        if machine == KNOWN:
            weights = likely(frame["text"].tolist(), frame["language"].tolist(), buckets)
            return pd.DataFrame({"machine": [machine], "weights": [weights.tobytes()]})
        lines = [(line, side) for t, side in zip(frame["text"], (_side(machine, x) for x in frame["language"]), strict=True)
                 for line in t.split("\n") if any(map(str.isalpha, line))]
        vectors = [v for at in range(0, len(lines), 500)
                   for v in Grams(pa.array([x for x, _ in lines[at : at + 500]]), buckets).vectors()]
        weights = train(vectors, np.array([s for _, s in lines]), buckets)
        return pd.DataFrame({"machine": [machine], "weights": [weights.tobytes()]})

    made = near.withColumn("machine", F.explode(wanted)).groupBy("machine").applyInPandas(
        learn, "machine string, weights binary").collect()
    return Model(list(counts), {r[0]: np.frombuffer(r[1], np.float32) for r in made}, buckets)


def by_size(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Neighbouring texts of ``most`` bytes together, or one longer text alone: working memory follows the bytes."""
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
        yield texts[at:to]
        at = to


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``known``.

    The first two are ``und`` and 0 where the text is NULL or has no letter, and
    where nothing was learned. ``known`` is false there too, and where the text is
    not likely in any of the languages learned, whichever of them is nearest.
    Equal texts get equal answers, whole texts are read, and an empty table gives
    an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size depends on the labels, not on the rows

    @F.arrow_udf("struct<lang_pred: string, score: double, known: boolean>")
    def judge(texts: pa.Array) -> pa.Array:
        found = [(pa.array([], pa.string()), pa.array([], pa.float64()), pa.array([], pa.bool_()))]
        for part in by_size(pc.fill_null(texts, ""), 1 << 18):
            name, score, known = shared.value.predict(part)
            lettered = pc.match_substring_regex(part, LETTER).to_numpy(zero_copy_only=False)
            found.append((pa.array([x if ok else UNKNOWN for x, ok in zip(name, lettered, strict=True)], pa.string()),
                          pa.array(np.where(lettered, score, 0.0)), pa.array(known & lettered)))
        out = [pa.concat_arrays(c) for c in zip(*found, strict=True)]
        trim()
        return pa.StructArray.from_arrays(out, ["lang_pred", "score", "known"])

    named = docs.withColumn("_judged", judge(F.col(text)))
    return named.select(*[F.col(f"`{c}`") for c in docs.columns], "_judged.lang_pred", "_judged.score", "_judged.known")


def held_out(key: Column | str, parts: int, rest: int) -> Column:
    """Whether a row's key falls into the part kept from learning; false without a key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % parts == rest, F.lit(False))
