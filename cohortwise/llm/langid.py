"""Language identification by prediction with partial matching over bytes.

Each language has a tree of byte contexts up to ``ORDER`` bytes. The code length of a byte is read from its
longest context that occurred with it in training; every longer context that occurred without it costs an
escape: ``distinct / (total + distinct)``. Below the empty context all 256 bytes are equal. Statistics are
frozen, so the length of a text is the exact sum over all its bytes, in any order of work. The language with
the shortest code wins; ``score`` is its posterior share, ``1 / sum(2 ** (best - bits))``.

Training counts come from a bounded sample of labelled rows: in expectation ``SAMPLE`` whole texts per
language, chosen by a hash of the text. The model therefore has a bounded size, whatever the corpus, and is
sent to the executors as one value. Prediction is one pass over the whole texts without a shuffle.

Defined cases: null texts and texts without a letter are ``und`` with score 0; with nothing to learn from
every text is ``und``; ties go to the language that sorts first; other columns and null labels are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, texts_of

ORDER = 3
#: Labelled texts per language that are learned from, in expectation.
SAMPLE = 3000
#: N-grams below this count per language are dropped from the top order of a model, after the lower orders are counted.
LEAST_COUNT = 2

_LETTER = regex.compile(r"\p{L}")


def _grams(data: np.ndarray, width: int) -> np.ndarray:
    """Every run of ``width`` bytes as a number."""
    code = np.zeros(max(0, len(data) - width + 1), np.uint64)
    for k in range(width):
        code = (code << np.uint64(8)) | data[k : len(data) - width + 1 + k].astype(np.uint64)
    return code


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over whole texts; texts are led by ``ORDER`` line feeds as their first context."""

    def run(batches):
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), [t or b"" for t in texts_of(batch)]
            for part, some in chunks(langs, texts):
                for lang in sorted(set(part)):
                    grams = [_grams(np.frombuffer(b"\n" * ORDER + t, np.uint8), ORDER + 1) for x, t in zip(part, some, strict=True) if x == lang]
                    values, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"],
                    )

    counted = labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def training_sample(labelled: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return labelled.join(F.broadcast(sizes), "lang").where(draw < per_language / F.col("rows")).select("lang", "text")


class Model:
    """Code lengths in bits for every known context and byte, one column per language."""

    def __init__(self, langs: list[str], grams: np.ndarray, lang_of: np.ndarray, n: np.ndarray, least: int = 1):
        self.langs = langs
        size = len(langs)
        lower = np.full((256, size), 8.0)  # every byte alike below the empty context
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        previous_codes = np.arange(256, dtype=np.uint64)
        for order in range(ORDER + 1):
            if order == ORDER:
                grams, lang_of, n = grams[n >= least], lang_of[n >= least], n[n >= least]
            known, inverse = np.unique(grams & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
            counts = np.zeros((len(known), size))
            np.add.at(counts, (inverse, lang_of), n)
            contexts, owner = np.unique(known >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((len(contexts), size)), np.zeros((len(contexts), size))
            np.add.at(total, owner, counts)
            np.add.at(distinct, owner, counts > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                own = -np.log2(counts / (total + distinct)[owner])
            shorter = np.searchsorted(previous_codes, known & np.uint64((1 << 8 * max(order, 1)) - 1))
            cost = np.where(counts > 0, own, escape[owner] + lower[shorter])
            if order == 0:  # all bytes, seen or not
                full = np.repeat(escape, 256, 0) + 8.0 if len(escape) else np.full((256, size), 8.0)
                full[known.astype(int)] = cost
                known, cost = np.arange(256, dtype=np.uint64), full
            self.levels.append((known, cost, contexts, escape))
            previous_codes, lower = known, cost

    def bits(self, data: np.ndarray) -> np.ndarray:
        """Code length per byte after the first ``ORDER`` bytes, and per language."""
        grams = _grams(data, ORDER + 1)
        return self._cost(grams, ORDER)

    def _cost(self, grams: np.ndarray, order: int) -> np.ndarray:
        known, cost, contexts, escape = self.levels[order]
        codes = grams & np.uint64((1 << 8 * (order + 1)) - 1)
        place, found = self._find(order, codes, known)
        result = cost[place]
        missing = np.flatnonzero(~found)
        if len(missing):
            context = codes[missing] >> np.uint64(8)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            lost = np.where((contexts[at] == context)[:, None], escape[at], 0.0)
            result[missing] = lost + self._cost(grams[missing], order - 1)
        return result

    def _find(self, order: int, codes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the sorted codes, through a table of their leading bits."""
        table, mask = self._tables()[order]
        slot = ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)) & mask
        place = table[slot]
        found = known[place] == codes
        rest = np.flatnonzero(~found)  # another code lies in the slot
        if len(rest):
            at = np.minimum(np.searchsorted(known, codes[rest]), len(known) - 1)
            place[rest] = at
            found[rest] = known[at] == codes[rest]
        return place, found

    def _tables(self):
        """Direct tables over a hash of the codes; built once in each process."""
        if not hasattr(self, "_slots"):
            self._slots = []
            for known, *_ in self.levels:
                table = np.zeros(1 << 20, np.int32)
                slot = (known * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
                table[slot.astype(np.int64)] = np.arange(len(known), dtype=np.int32)
                self._slots.append((table, np.uint64((1 << 20) - 1)))
        return self._slots

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_slots"}

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Total bits of each text under each language."""
        data = np.frombuffer(b"".join(b"\n" * ORDER + t for t in texts), np.uint8)
        cost = self.bits(data)
        ends = np.cumsum([len(t) + ORDER for t in texts])
        starts = ends - [len(t) + ORDER for t in texts]
        out = np.zeros((len(texts), len(self.langs)))
        for i, (start, end) in enumerate(zip(starts, ends - ORDER, strict=True)):
            out[i] = cost[start:end].sum(0)
        return out


def learn(labelled: DataFrame, per_language: int = SAMPLE) -> Model | None:
    """A model from rows (lang, text); None if there is nothing to learn from."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    counts = count_grams(training_sample(usable, per_language)).toPandas()  # bounded by the sample
    if counts.empty:
        return None
    langs = sorted(counts["lang"].unique())
    return Model(langs, counts["gram"].to_numpy(np.uint64), counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(), counts["n"].to_numpy(float), LEAST_COUNT)


def predict(docs: DataFrame, model: Model | None, keep: dict[str, Column]) -> DataFrame:
    """The ``keep`` columns with lang_pred and score, from the text alone."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    kept = docs.select(*[c.alias(k) for k, c in keep.items()], F.col("text").alias("__text"))
    names = list(keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches):
        known = sent.value
        for batch in batches:
            texts = [t or b"" for t in texts_of(batch, "__text")]
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            usable = [i for i, t in enumerate(texts) if known is not None and _LETTER.search(t.decode("utf-8", "replace"))]
            for part, some in chunks(usable, [texts[i] for i in usable]):
                bits = known.lengths(some)
                best = bits.argmin(1)
                share = 1 / np.exp2(bits.min(1)[:, None] - bits).sum(1)
                for i, b, s in zip(part, best, share, strict=True):
                    langs[i], scores[i] = known.langs[b], float(s)
            columns = [batch.column(k) for k in names] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score"])

    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double")
