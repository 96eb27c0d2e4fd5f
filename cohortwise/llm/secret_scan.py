"""Secret scans: fixed patterns, and character Markov models for what the patterns do not name.

Two first-order models over characters, one of random strings and one of ordinary identifiers, are trained
from labelled samples. A token is random if the log-likelihood ratio of the two models is high, in total and
per character. Labels come from the patterns (their finds are secrets), from generated digests in several
alphabets (random), and from words that several texts have (ordinary). Training reads a bounded sample of documents, in
expectation ``SAMPLE_DOCS`` whole texts by a hash of the text; the models are one table with a number for each
pair of characters of a fixed alphabet, whatever the corpus. Scanning is one pass of built-in functions over
the whole texts, without a shuffle; its work grows in proportion to the text, however many spans there are.

Kinds of spans, in order: assign, access, hex (the patterns), markov (added; never where a pattern's span is).
Positions count code points; the end is exclusive.

Defined cases: a null text is empty and has no spans; repeated rows are scanned each; other columns are kept
out of the way; empty tables give empty results, and without samples nothing is added to the patterns' spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

#: Fixed patterns, and the least length of the part that counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
#: Runs of a class that must be long need no second test: the shorter runs are no finds.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

#: Tokens that the models score.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"[A-Za-z0-9_-]{6,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET) + 1  # one more for every other character
#: Texts that the models learn ordinary words and labelled secrets from, in expectation.
SAMPLE_DOCS = 2000
#: Log-likelihood ratio in bits that a random token reaches, and per character.
LEAST_BITS, LEAST_RATE = 20.0, 0.75
#: Elements of an array that are worked on together, and characters of a text.
BLOCK = 64
PIECE = 512
_SPAN = "struct<start: int, kind: int, end: int, value: string>"
_SMOOTHING = 0.25
#: Weight, in characters, of a character's overall share against what was seen after the one before.
_PRIOR = 8.0


def finds(text: str, pattern: str) -> tuple[Column, Column]:
    """The matches of a pattern in a column, and the texts between them (None if there is no match)."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    return found, F.split(F.col(text), pattern, -1)


def _running(array: str, kind: str, step: str, emit: str) -> str:
    """SQL for an array of ``emit`` for each element ``x``, given ``at``: zero, then ``step`` of it at each element.

    Appending to an array copies it, so the array is worked on in blocks: first the values of ``at`` at which blocks
    begin, then each block by itself.
    """
    let = lambda value, name, body: f"transform(array({value}), {name} -> {body})[0]"
    inner = "named_struct('at', {0}, 'out', {1})".format(step.replace("@at", "acc.at"), f"concat(acc.out, {emit.replace('@at', 'acc.at')})")
    first = f"named_struct('at', begins[k], 'out', cast(array() as array<{kind}>))"
    each = f"flatten(transform(blocks, (block, k) -> aggregate(block, {first}, (acc, x) -> {inner}, acc -> acc.out)))"
    begins = f"aggregate(blocks, array(0), (seen, block) -> concat(seen, array(aggregate(block, element_at(seen, -1), (at, x) -> {step.replace('@at', 'at')}))))"
    blocks = f"transform(sequence(0, greatest(size(items) - 1, 0) div {BLOCK}), k -> slice(items, k * {BLOCK} + 1, {BLOCK}))"
    return let(array, "items", let(blocks, "blocks", let(begins, "begins", each)))


def _spans(found: str, between: str, kind: str) -> Column:
    """Structs (start, kind number, end, value) of matches, by the lengths of the texts between them."""
    number, m, b = KINDS.index(kind), f"x.{found}", f"x.{between}"  # the texts between are one more
    start = f"@at + char_length({b})"
    span = f"named_struct('start', {start}, 'kind', {number}, 'end', {start} + char_length({m}), 'value', {m})"
    step = f"@at + char_length({b}) + coalesce(char_length({m}), 0)"
    none = f"cast(array() as array<{_SPAN}>)"
    return F.expr(_running(f"arrays_zip({found}, {between})", _SPAN, step, f"if({m} is null, {none}, array({span}))"))


def pattern_spans(docs: DataFrame, keep: list[str], tokens: bool = True) -> DataFrame:
    """``keep`` columns, __text, and arrays assign, access, hex (and markov: tokens yet to be scored)."""
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, **({"markov": TOKEN} if tokens else {})}
    named = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    matched = named.withColumns({f"__{k}": finds("__text", p)[0] for k, p in patterns.items()})
    # texts without a match are not split
    split = matched.withColumns({f"__{k}_b": F.when(F.size(f"__{k}") > 0, finds("__text", p)[1]) for k, p in patterns.items()})
    none = f"cast(array() as array<{_SPAN}>)"
    spans = {k: F.when(F.size(f"__{k}") > 0, _spans(f"__{k}", f"__{k}_b", k)).otherwise(F.expr(none)) for k in patterns}
    result = split.select(*keep, "__text", *[c.alias(k) for k, c in spans.items()])
    long_enough = F.filter("assign", lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_VALUE)
    return result.withColumn("assign", long_enough)


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(sample, random, n): secrets found by the patterns and generated strings, and ordinary words.

    A word is ordinary if it stands in two different texts; what stands in one only may be a secret and is
    left without a label.
    """
    rows = docs.count()
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    some = pattern_spans(docs.select("text").where(draw < SAMPLE_DOCS / max(rows, 1)), [], tokens=False)
    secret = F.transform("assign", lambda s: F.regexp_extract(s["value"], ASSIGN, 2))
    secret = F.concat(secret, F.transform(F.concat("access", "hex"), lambda s: s["value"]))
    digest = F.unhex(F.sha2("__text", 256))
    generated = F.array(F.base64(digest), F.hex(digest), F.lower(F.hex(digest)), F.translate(F.base64(digest), "+/=", ""))
    # words inside a pattern's find are no ordinary words
    words = F.regexp_extract_all(F.regexp_replace(F.regexp_replace("__text", ASSIGN, " "), f"{ACCESS}|{HEX}", " "), F.lit(ORDINARY), F.lit(0))
    labelled = some.select(
        F.xxhash64("__text").alias("of"),
        F.explode(
            F.concat(
                F.transform(F.concat(secret, generated), lambda x: F.struct(x.alias("sample"), F.lit(True).alias("random"))),
                F.transform(words, lambda x: F.struct(x.alias("sample"), F.lit(False).alias("random"))),
            )
        ).alias("s"),
    )
    counted = labelled.groupBy("s.sample", "s.random").agg(F.count(F.lit(1)).alias("n"), F.min("of").alias("lo"), F.max("of").alias("hi"))
    return counted.where("random or lo < hi").select("sample", "random", "n")


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios in bits of random against ordinary, for each pair of character numbers."""
    pairs = samples.select(
        "random", "n", F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.char_length("sample"))), lambda i: F.substring("sample", i - 1, 2))).alias("p")
    )
    code = [F.instr(F.lit(ALPHABET), F.substring("p", k, 1)) for k in (1, 2)]
    counted = pairs.where(F.char_length("p") == 2).groupBy("random", code[0].alias("a"), code[1].alias("b")).agg(F.sum("n").alias("n"))
    counts = {r: [[0.0] * SIZE for _ in range(SIZE)] for r in (True, False)}
    for random, a, b, n in counted.collect():  # at most two numbers for each pair of the alphabet
        counts[random][a][b] += n
    tables = {r: _transitions(c) for r, c in counts.items()}
    return [math.log2(tables[True][i] / tables[False][i]) for i in range(SIZE**2)]


def _transitions(counts: list[list[float]]) -> list[float]:
    """Probabilities of each character after each other, drawn towards how common the character is at all."""
    common = [_SMOOTHING + sum(row[b] for row in counts) for b in range(SIZE)]
    share = [c / sum(common) for c in common]
    return [(row[b] + _PRIOR * share[b]) / (sum(row) + _PRIOR) for row in counts for b in range(SIZE)]


def _bits(ratios: list[float]) -> str:
    """SQL for the log-likelihood ratio of ``s.value``; the table is one folded literal."""
    table = "cast(split('" + ",".join(f"{r:.5f}" for r in ratios) + "', ',') as array<double>)"
    code = f"instr('{ALPHABET}', c)"
    step = f"named_struct('a', {code}, 'bits', acc.bits + if(acc.a < 0, 0.0D, {table}[acc.a * {SIZE} + {code}]))"
    return f"aggregate(split(s.value, ''), named_struct('a', -1, 'bits', 0.0D), (acc, c) -> {step}, acc -> acc.bits)"


def _grouped(array: str) -> str:
    """SQL for runs of ``BLOCK`` elements of a sorted array that have ``start`` and ``end``, with their bounds."""
    run = f"slice(items, k * {BLOCK} + 1, {BLOCK})"
    bounds = "named_struct('start', r[0].start, 'end', array_max(transform(r, e -> e.end)), 'held', r)"
    runs = f"transform(filter(transform(sequence(0, size(items) div {BLOCK}), k -> {run}), r -> size(r) > 0), r -> {bounds})"
    return f"transform(array({array}), items -> {runs})[0]"


def scan(docs: DataFrame, keep: list[str], ratios: list[float] | None = None) -> DataFrame:
    """``keep`` columns, __text, base (sorted spans of the patterns) and spans (with those added)."""
    if ratios is None:
        ratios = train(stage(labelled_samples(docs), "samples"))
    found = pattern_spans(docs, keep)
    base = F.array_sort(F.concat("assign", "access", "hex"))
    found = found.select(*keep, "__text", base.alias("base"), "markov")
    near = lambda e: f"({e}.start < s.end and s.start < {e}.end)"
    # spans near a token are sought through two levels of bounds
    apart = f"not exists(runs, g -> {near('g')} and exists(g.held, h -> {near('h')} and exists(h.held, b -> {near('b')})))"
    bits = _bits(ratios)
    random = f"filter(markov, s -> {apart} and {bits} >= greatest({LEAST_BITS}D, {LEAST_RATE}D * char_length(s.value)))"
    scored = found.withColumn("markov", F.when(F.size("markov") > 0, F.expr(f"transform(array({_grouped(_grouped('base'))}), runs -> {random})[0]")).otherwise(F.col("markov")))
    return scored.select(*keep, "__text", "base", F.array_sort(F.concat("base", "markov")).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"concat_ws(',', transform({spans}, s -> concat_ws(':', array({names})[s.kind], cast(s.start as string), cast(s.end as string))))")


def report(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """doc_id, the patterns' counts and digest, and all spans."""
    found = scan(docs, ["doc_id"], ratios)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def redact(docs: DataFrame, mark: str = "<secret>", ratios: list[float] | None = None) -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark`` and n_chars, if any, renewed."""
    columns = docs.columns
    found = scan(docs, columns, ratios)
    # spans come by start: a piece ends where a span begins that no earlier one covers; pieces are cut from short parts of the text
    first, last = f"@at div {PIECE}", f"(x.start - 1) div {PIECE}"
    cut = f"substring(array_join(slice(parts, {first} + 1, {last} - {first} + 1), ''), @at % {PIECE} + 1, x.start - @at)"
    emit = f"if(x.end <= @at or x.start < @at, cast(array() as array<string>), array(if(x.start = @at, '', {cut}), '{mark}'))"
    pieces = _running("spans", "string", "greatest(@at, x.end)", emit)
    end = "array_max(transform(spans, s -> s.end))"
    tail = f"array_join(slice(parts, {end} div {PIECE} + 1, size(parts)), '')"
    whole = f"concat(array_join({pieces}, ''), substring({tail}, {end} % {PIECE} + 1))"
    rebuilt = F.expr(f"transform(array(regexp_extract_all(__text, '(?s).{{1,{PIECE}}}', 0)), parts -> {whole})[0]")
    text = F.when(F.size("spans") > 0, rebuilt).otherwise(F.col("text"))
    changed = found.withColumn("__new", text)
    size = F.when(F.size("spans") > 0, F.char_length("__new").cast("long")).otherwise(F.col("n_chars")) if "n_chars" in columns else None
    return changed.select(*[F.col("__new").alias("text") if c == "text" else size.alias(c) if c == "n_chars" else F.col(c) for c in columns])
