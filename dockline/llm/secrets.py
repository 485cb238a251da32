"""Secret scans: fixed patterns, and character Markov models for the rest.

All of it is DataFrame functions. Every run of 16 characters and more is cut at
its separators, the pieces are scored by the ratio of two character Markov
models, one of random strings and one of ordinary words and identifiers, and
the stretches of pieces that score best are what the models find. Both models
are counted on labelled samples. The work is linear in a text's length.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns, and the least length of what they find.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE_CHARS = 12
ACCESS = "AKIA[A-Z0-9]{14,}"  # 18 characters and more; the longest run is taken either way
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
SIZE = len(ALPHABET) + 1  # 0 stands for the end of a piece
LEAST_CHARS = 16
SEPARATOR = "[+/_=-]"
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}+"
ORDINARY = "[A-Za-z0-9]{2,}+"
# Natural log of the odds that a stretch must reach.
ODDS = 8.0
# The mean per character that it must reach too: so many standard deviations of ordinary words
# of LEAST_CHARS characters above their mean, but no less and no more than these bounds, the
# upper one as a share of what secrets score.
DEVIATIONS, PER_CHAR_FLOOR, PER_CHAR_SHARE = 4.0, 0.4, 0.5
REDACTED = "[SECRET]"
# Elements that one step of a running aggregate copies at most.
BLOCK = 256

_SPAN = "struct<start:int,kind:int,end:int,value:string>"


class Models(NamedTuple):
    """Log-likelihood ratios of character pairs, at first * SIZE + second, and the least mean per character."""

    ratios: list[float]
    per_char: float


def let(value: Column, body) -> Column:
    """`body` of the value, which is worked out once, also where a lambda names it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(values: Column) -> Column:
    last = F.greatest(F.floor((F.size(values) - 1) / BLOCK).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))


def running(values: Column, op, zero: int = 0) -> Column:
    """What the associative `op` makes of all values up to each one, as array<int>.

    Blocks are gone through by themselves, so an array is not copied once per element.
    """
    zero = F.lit(zero)

    def within(block, start):
        init = F.struct(start.alias("last"), F.expr("cast(array() as array<int>)").alias("got"))
        step = lambda acc, x: F.struct(
            op(acc["last"], x).alias("last"), F.array_append(acc["got"], op(acc["last"], x)).alias("got"))
        return F.aggregate(block, init, step, lambda acc: acc["got"])

    def all_blocks(blocks):
        sums = within(F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: op(a, x))), zero)
        return let(sums, lambda sums: F.flatten(F.transform(
            blocks, lambda b, i: within(b, F.coalesce(F.get(sums, i - 1), zero)))))

    return let(values, lambda v: let(blocks(v), all_blocks))


def spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Matches of the pattern as array<struct<start, kind, end, value>>; those with a short group go.

    Code points, end exclusive. Where a match starts follows from the lengths
    of what lies between matches.
    """
    empty = F.expr(f"cast(array() as array<{_SPAN}>)")

    def placed(between, match):
        lengths = F.zip_with(between, match, lambda b, m: F.length(b) + F.coalesce(F.length(m), F.lit(0)))
        value = match if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        zipped = F.arrays_zip(match.alias("match"), value.alias("value"), running(lengths, lambda a, b: a + b).alias("end"))
        named = F.transform(zipped, lambda x: F.struct(
            (x["end"] - F.length(x["match"])).alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["value"].alias("value")))
        return F.filter(named, lambda x: F.length(x["value"]) >= least)

    found = let(F.struct(F.split(text, pattern, -1).alias("b"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")),
                 lambda x: placed(x["b"], x["m"]))
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(empty)


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": spans(text, ASSIGN, 0, 2, ASSIGN_VALUE_CHARS),
        "access": spans(text, ACCESS, 1),
        "hex": spans(text, HEX, 2),
    }


def samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """Labelled samples (value, secret) from all documents, null texts counting as empty.

    What the fixed patterns find is labelled a random string, every other word
    or part of an identifier ordinary. Repeated rows count repeatedly.
    """
    own = docs.select(F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    held = own.where(F.regexp_like("_text", F.lit(f"{ASSIGN}|{ACCESS}|{HEX}")))
    secret = held.select(F.explode(F.concat(*base_spans(F.col("_text")).values())).alias("s")).select(
        F.col("s.value").alias("value"), F.lit(True).alias("secret"))
    clean = F.regexp_replace("_text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    words = own.select(F.explode(F.regexp_extract_all(clean, F.lit(ORDINARY), F.lit(0))).alias("value"))
    return secret.unionByName(words.select("value", F.lit(False).alias("secret")))


def fit(labelled: DataFrame) -> Models:
    """The models of labelled samples (value, secret); rows with a null are left out.

    The samples are counted in Spark; what comes back is one row per pair. Pairs
    are smoothed with half a count. Without samples of both labels all ratios
    are 0, so nothing is found.
    """
    at = lambda c: F.instr(F.lit(ALPHABET), c)
    values = labelled.where("value is not null and secret is not null").groupBy("value", "secret").count()
    pieces = values.select("secret", "count", F.explode(F.split("value", "[^A-Za-z0-9]")).alias("piece")).where("piece <> ''")
    padded = F.concat(F.lit(" "), "piece", F.lit(" "))
    pairs = pieces.select("secret", "count", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("piece") + 1), lambda i: F.substr(padded, i, F.lit(2)))).alias("pair"),
    ).groupBy("secret", "pair").agg(F.sum("count").alias("n"))
    coded = pairs.select("secret", "n", (at(F.substring("pair", 1, 1)) * SIZE + at(F.substring("pair", 2, 1))).alias("code"))
    counts = {True: [0.0] * SIZE * SIZE, False: [0.0] * SIZE * SIZE}
    for r in coded.groupBy("secret", "code").agg(F.sum("n").alias("n")).collect():  # 2 * SIZE * SIZE rows at most
        counts[r.secret][r.code] += r.n
    seen = {s: sum(c) for s, c in counts.items()}
    if not seen[True] or not seen[False]:
        return Models([0.0] * SIZE * SIZE, PER_CHAR_FLOOR)
    ratios = []
    for first in range(SIZE):
        a, b = ([c + 0.5 for c in counts[s][first * SIZE : (first + 1) * SIZE]] for s in (True, False))
        ratios += [math.log(x / sum(a)) - math.log(y / sum(b)) for x, y in zip(a, b, strict=True)]
    mean = {s: sum(c * r for c, r in zip(counts[s], ratios, strict=True)) / seen[s] for s in counts}
    square = sum(c * r * r for c, r in zip(counts[False], ratios, strict=True)) / seen[False]
    deviation = math.sqrt(max(square - mean[False] ** 2, 0.0) / LEAST_CHARS)
    limit = min(mean[False] + DEVIATIONS * deviation, PER_CHAR_SHARE * mean[True])
    return Models(ratios, max(limit, PER_CHAR_FLOOR))


def _score(piece: Column, table: Column) -> Column:
    """Log-likelihood ratio of one piece, its ends included."""
    step = lambda acc, c: let(F.instr(F.lit(ALPHABET), c), lambda code: F.struct(
        code.alias("last"), (acc["sum"] + F.get(table, acc["last"] * SIZE + code)).alias("sum")))
    done = lambda acc: acc["sum"] + F.get(table, acc["last"] * SIZE)
    init = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.when(F.length(piece) == 0, F.lit(0.0)).otherwise(F.aggregate(F.split(piece, ""), init, step, done))


def _stretches(run: Column, models: Models, table: Column) -> Column:
    """The stretches of a run's pieces that the models hold for random strings.

    A stretch begins with a piece that scores above 0 and ends where its sum is
    greatest; it is closed where the sum has fallen to 0 or by ODDS, so no
    further piece could lead to a greater one.
    """
    none = F.expr(f"cast(array() as array<{_SPAN}>)")
    init = F.struct(
        run["start"].alias("at"), run["start"].alias("from"), run["start"].alias("to"),
        F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), none.alias("got"))

    def closed(acc):
        chars = acc["to"] - acc["from"]
        good = (chars >= LEAST_CHARS) & (acc["best"] >= ODDS) & (acc["best"] >= models.per_char * chars)
        span = F.struct(
            acc["from"].alias("start"), F.lit(3).alias("kind"), acc["to"].alias("end"),
            F.substr(run["value"], acc["from"] - run["start"] + 1, chars).alias("value"))
        return F.when(good, F.array_append(acc["got"], span)).otherwise(acc["got"])

    def step(acc, piece):
        after = acc["at"] + F.length(piece)

        def with_sum(total):
            up = total > acc["best"]
            drop = (total <= 0) | (total <= acc["best"] - ODDS)
            opens = acc["best"] == 0
            kept = F.struct(
                (after + 1).alias("at"), F.when(opens, acc["at"]).otherwise(acc["from"]).alias("from"),
                F.when(up, after).otherwise(acc["to"]).alias("to"), total.alias("sum"),
                F.when(up, total).otherwise(acc["best"]).alias("best"), acc["got"].alias("got"))
            fresh = F.struct(
                (after + 1).alias("at"), (after + 1).alias("from"), (after + 1).alias("to"),
                F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), closed(acc).alias("got"))
            return F.when(drop, fresh).otherwise(kept)

        return let(acc["sum"] + _score(piece, table), with_sum)

    return F.aggregate(F.split(run["value"], SEPARATOR), init, step, closed)


def _markov(text: Column, models: Models) -> Column:
    """Spans that the models hold for random strings."""
    table = F.expr(f"cast(split('{','.join(f'{x:.4f}' for x in models.ratios)}', ',') as array<double>)")
    return F.flatten(F.transform(spans(text, CANDIDATE, 3), lambda run: _stretches(run, models, table)))


def apart(base: Column, more: Column, kind: int) -> Column:
    """All spans of `base`, of kinds below `kind`, and those of `more`, which has that kind, that overlap none of them, in order."""
    def chosen(all_):
        ends = F.transform(all_, lambda s: F.when(s["kind"] < kind, s["end"]).otherwise(0))
        starts = F.transform(F.reverse(all_), lambda s: F.when(s["kind"] < kind, s["start"]).otherwise(_FAR))
        marked = F.arrays_zip(
            all_.alias("s"), running(ends, F.greatest).alias("before"),
            F.reverse(running(starts, F.least, _FAR)).alias("after"))
        kept = F.filter(marked, lambda x: (x["s"]["kind"] < kind) | (
            (x["before"] <= x["s"]["start"]) & (x["after"] >= x["s"]["end"])))
        return F.transform(kept, lambda x: x["s"])

    return let(F.struct(base.alias("base"), more.alias("more")), lambda x: F.when(
        F.size(x["more"]) == 0, F.array_sort(x["base"])).otherwise(let(F.array_sort(F.concat(x["base"], x["more"])), chosen)))


_FAR = (1 << 31) - 1


def scan(docs: DataFrame, models: Models, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, n_assign, n_access, n_hex, n_markov and `found`, all spans in order.

    `found` has structs of start, kind (place in KINDS), end and value; code
    points, end exclusive. The models only add spans, where no pattern found
    one. A null text counts as empty and has none; repeated rows stay.
    """
    made = ("n_assign", "n_access", "n_hex", "n_markov", "found")
    columns = [docs[c] for c in keep if c not in made]
    own = docs.select(*columns, F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    own = own.withColumns({"_base": F.concat(*base_spans(F.col("_text")).values()), "_markov": _markov(F.col("_text"), models)})
    own = own.withColumn("found", apart(F.col("_base"), F.col("_markov"), 3))
    counted = lambda i: F.size(F.filter("found", lambda s: s["kind"] == i)).cast("bigint")
    return own.select(
        *(F.col(c) for c in keep if c not in made),
        *(counted(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), "found")


def spans_text(found: Column, base_only: bool = False) -> Column:
    """kind:start:end of the spans, comma-joined."""
    spans = F.filter(found, lambda s: s["kind"] < 3) if base_only else found
    name = lambda s: F.get(F.array(*(F.lit(k) for k in KINDS)), s["kind"])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """The rows of docs with REDACTED in place of every secret; n_chars, if there is one, follows.

    Spans that overlap are replaced as one. Texts without secrets stay as they
    are, null included.
    """
    names = docs.columns
    found = scan(docs.withColumn("_own", docs[text].cast("string")), models, [*names, "_own"], text)

    def between(reach):
        """What stays, as (from, to): up to each span that begins at or after the end of all before it."""
        before = F.concat(F.array(F.lit(0)), reach)
        starts = F.concat(F.transform("found", lambda s: s["start"]), F.array(F.length("_own")))
        both = F.zip_with(before, starts, lambda a, b: F.struct(a.alias("from"), b.alias("to")))
        return F.filter(both, lambda x: x["to"] >= x["from"])

    def cut(block):
        low, high = F.get(block, F.lit(0))["from"], F.element_at(block, -1)["to"]
        return let(F.substr("_own", low + 1, high - low), lambda part: F.transform(
            block, lambda x: F.substr(part, x["from"] - low + 1, x["to"] - x["from"])))

    reach = running(F.transform("found", lambda s: s["end"]), F.greatest)
    pieces = let(between(reach), lambda b: F.flatten(F.transform(blocks(b), cut)))
    out = found.withColumn("_new", F.when(F.size("found") > 0, F.array_join(pieces, REDACTED)).otherwise(F.col("_own")))
    changed = {text: F.col("_new")}
    if "n_chars" in names:
        changed["n_chars"] = F.when(F.size("found") > 0, F.length("_new")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*(changed.get(c, F.col(c)).alias(c) for c in names))
