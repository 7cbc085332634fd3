"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line, or a part of one: within a line it ends at the first word after the 31st
that ends in one of three letters, so that after a change within a line the paragraphs soon are
the old ones again, and after 96 words at the latest; a word of more than 64 letters counts as
several. So a paragraph has about 6,000 characters at most, and a text of one line shares with
its edited form what it has in common with it, if it has more than a paragraph or two. A
paragraph's digest is a 64-bit hash of it, without white space at its end. A sketch has three tables
of ``SLOTS`` cells. Every distinct digest is added to one cell of each table: a cell holds the
number of its digests, their exclusive or, and that of their check hashes. Subtracting the
sketches of two versions leaves the digests that differ. A cell with a single one (count 1 or
-1, fitting check) shows it; it is taken out of its other cells, and so on: peeling. The
likeness is 1 less the differing digests' share of both versions' digests.

Where peeling gets stuck the sketch was too small for the difference. Then a larger one is
taken: several sketches side by side, the digests dealt to them by a hash, about ``EACH`` for
each; one that still fails is split in two again, with other hashes, until all are peeled.

Spark's own functions only; a sketch is an array in its row. The next document in ascending
doc_id is found by sorting within ranges of ids, so that the text is shuffled once; the first
and last rows of the ranges are matched apart.

Defined cases: a null text counts as empty, and two empty texts are alike (1). Rows with one
doc_id follow by a digest of their text; null ids come last. A single document follows itself;
an empty table gives no rows. Columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlift.llm.common import stage
from starlift.operators.keys import dense_keys

SLOTS, TABLES, ROUNDS = 16, 3, 12
#: Digests that a small sketch is meant for, and documents in a range of ids on average.
EACH, RANGE = 8, 2048

_CELL = "struct<n:int,key:bigint,check:bigint>"


# The words of a paragraph within a line.
PARAGRAPH = r"(?:\S{1,64}+\s*+){31,95}?\S{0,63}[aeo](?=\s)|(?:\S{1,64}+\s*+){1,96}"


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    pieces = F.transform(F.split(text, "\n"), lambda line: F.regexp_extract_all(line, F.lit(PARAGRAPH), F.lit(0)))
    return F.array_distinct(F.transform(F.flatten(pieces), lambda piece: F.xxhash64(F.regexp_replace(piece, r"\s+$", ""))))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.alias("key"), check.alias("check"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _keyed(keys: Column, seed: int, sign: Callable[[Column], Column] = lambda key: F.lit(1)) -> Column:
    """Digests with what a cell takes of them: sign, check and the hash that gives the slots."""
    mixed = (lambda key: F.xxhash64(key, F.lit(seed))) if seed else lambda key: key
    return F.transform(
        keys, lambda k: F.struct(sign(k).alias("n"), k.alias("key"), _check(k).alias("check"), mixed(k).alias("slots"))
    )


def _added(cells: Column | None, keyed: Column, sign: int) -> Column:
    """Digests added to (sign 1) or taken from (-1) the cells; without cells, to empty ones."""
    zero = F.lit(0).cast("long")

    def cell(table: int, slot: Column, begin: Column) -> Column:
        own = F.filter(keyed, lambda k: F.shiftright(k["slots"], 20 * table).bitwiseAND(F.lit(SLOTS - 1)) == slot)
        add = lambda c, k: _cell(c["n"] + sign * k["n"], c["key"].bitwiseXOR(k["key"]), c["check"].bitwiseXOR(k["check"]))
        return F.aggregate(own, begin, add)

    def table_of(table: int) -> Column:
        if cells is None:
            slots = F.sequence(F.lit(0), F.lit(SLOTS - 1))
            return F.transform(slots, lambda slot: cell(table, slot, _cell(F.lit(0), zero, zero)))
        return F.transform(F.slice(cells, table * SLOTS + 1, SLOTS), lambda c, slot: cell(table, slot, c))

    return F.concat(*(table_of(table) for table in range(TABLES)))


def sketch(keys: Column, seed: int = 0) -> Column:
    """The cells of distinct digests."""
    return _let(_keyed(keys, seed), lambda keyed: _added(None, keyed, 1))


def as_text(cells: Column) -> Column:
    """The cells that aren't empty, as hexadecimal place, count, digests and checks."""
    used = F.filter(
        F.transform(cells, lambda c, at: F.struct(at.alias("at"), c["n"].alias("n"), c["key"].alias("key"), c["check"].alias("check"))),
        lambda c: c["n"] != 0,
    )
    one = lambda c: F.lower(F.concat_ws(":", F.hex(c["at"]), F.hex(c["n"]), F.hex(c["key"]), F.hex(c["check"])))
    return F.array_join(F.transform(used, one), ",")


def less(left: Column, right: Column) -> Column:
    """One sketch subtracted from another."""
    return F.zip_with(
        left, right,
        lambda a, b: _cell(a["n"] - b["n"], a["key"].bitwiseXOR(b["key"]), a["check"].bitwiseXOR(b["check"])),
    )


def peeled(cells: Column, seed: int = 0) -> Column:
    """The digests that a difference of sketches holds, each with its sign; null if peeling
    gets stuck."""
    kinds = f"cells: array<{_CELL}>, found: array<struct<key:bigint,n:int>>, go: boolean"
    begin = F.struct(cells.alias("cells"), F.array().alias("found"), F.lit(True).alias("go")).cast(f"struct<{kinds}>")
    mixed = (lambda key: F.xxhash64(key, F.lit(seed))) if seed else lambda key: key

    def further(state: Column, pure: Column) -> Column:
        rest = F.struct(
            _added(state["cells"], pure, -1).alias("cells"),
            F.concat(state["found"], F.transform(pure, lambda p: F.struct(p["key"].alias("key"), p["n"].alias("n")))).alias("found"),
            F.lit(True).alias("go"),
        )
        stop = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("go"))
        return F.when(F.size(pure) > 0, rest).otherwise(stop)

    def step(state: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["key"]) == c["check"]))
        pure = F.transform(pure, lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key"), c["check"].alias("check"), mixed(c["key"]).alias("slots")))
        return _let(F.array_distinct(pure), lambda pure: further(state, pure))

    def done(state: Column) -> Column:
        empty = F.forall(state["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0))
        return F.when(empty, state["found"])

    steps = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(steps, begin, lambda state, _: F.when(state["go"], step(state)).otherwise(state), done)


def _successors(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with own, n_chars, edited_sha256, edited and next: the digests of
    the text, its edited one and the next one; written, with a ``row`` number."""
    known = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    width = max(1, ((known[1] or 0) - (known[0] or 0) + 1) * RANGE // max(1, known[2]))
    bucket = F.coalesce(F.floor(F.col("doc_id") / width), F.lit((known[1] or 0) // width + 1)).cast("long")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    within = Window.partitionBy("bucket").orderBy(*order)
    led = rows.withColumn("bucket", bucket).select(
        "bucket", "doc_id", "text",
        F.lead("text").over(within).alias("next_text"), (F.lag(F.lit(1)).over(within).isNull()).alias("head"),
    )

    def described(led: DataFrame, *more: Column) -> DataFrame:
        n = F.char_length("text")
        half = F.floor(n / 2).cast("int")
        edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
        return led.withColumn("edited_text", edited).select(
            "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"), digests(F.col("edited_text")).alias("edited"), digests(F.col("next_text")).alias("next"), *more,
        )

    tail = F.col("next_text").isNull()
    first = stage(
        described(led, "bucket", F.when(F.col("head"), F.col("text")).alias("head_text"), F.when(tail, F.col("text")).alias("tail_text")),
        "successors",
    )
    heads = first.filter("head_text is not null").select("bucket", F.col("head_text").alias("next_text"))
    places = dense_keys(heads.select("bucket"), "place", ["bucket"])
    last = F.lit(places.agg(F.max("place")).first()[0] or 1)
    onward = places.select(F.when(F.col("place") == 1, last + 1).otherwise(F.col("place")).alias("place"), F.col("bucket").alias("next_bucket"))
    following = places.withColumn("place", F.col("place") + 1).join(onward, "place").select("bucket", "next_bucket")
    tails = first.filter("tail_text is not null").select("doc_id", F.col("tail_text").alias("text"), "bucket")
    tails = tails.join(following, "bucket").join(heads.withColumnRenamed("bucket", "next_bucket"), "next_bucket")
    columns = ["doc_id", "n_chars", "edited_sha256", "own", "edited", "next"]
    return first.filter("tail_text is null").select(*columns).unionByName(described(tails).select(*columns))


def _retried(stuck: DataFrame) -> DataFrame:
    """Differing digests (row, pair, apart) of pairs whose first sketch was too small."""
    sides = F.concat(
        F.transform("own", lambda key: F.struct(key.alias("key"), F.lit(1).alias("sign"))),
        F.transform("other", lambda key: F.struct(key.alias("key"), F.lit(-1).alias("sign"))),
    )
    many = F.ceil((F.size("own") + F.size("other")) / EACH)
    keys = stuck.select("row", "pair", many.alias("many"), F.explode(sides).alias("k"))
    keys = keys.select("row", "pair", F.pmod(F.xxhash64("k.key", F.lit("part")), "many").alias("part"), "k")
    done, seed = None, 1
    while True:
        dealt = keys.groupBy("row", "pair", "part").agg(F.collect_list("k").alias("keys"))
        side = lambda sign: F.transform(F.filter("keys", lambda k: k["sign"] == sign), lambda k: k["key"])
        found = peeled(less(sketch(side(1), seed), sketch(side(-1), seed)), seed)
        tried = stage(dealt.withColumn("found", found), "peeled")
        ready = tried.filter("found is not null").groupBy("row", "pair").agg(F.sum(F.array_size("found")).alias("apart"))
        done = ready if done is None else done.unionByName(ready)
        failed = tried.filter("found is null")
        if failed.isEmpty():
            return done.groupBy("row", "pair").agg(F.sum("apart").alias("apart"))
        keys = failed.select("row", "pair", "part", F.explode("keys").alias("k"))
        keys = keys.select("row", "pair", F.xxhash64("part", F.pmod(F.xxhash64("k.key", F.lit(seed)), F.lit(2))).alias("part"), "k")
        seed += 1


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next. Edited: the last half of the code points replaced by as many (or
    all) of the first ones of the next document; after the last comes the first."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = _successors(rows).withColumn("row", F.monotonically_increasing_id())
    cells = known.withColumns({f"{name}_cells": sketch(F.col(name)) for name in ("own", "edited", "next")})
    apart = {name: F.array_size(peeled(less(F.col("own_cells"), F.col(f"{name}_cells")))) for name in ("edited", "next")}
    first = cells.select(
        "row", "doc_id", "n_chars", "edited_sha256", "own", "edited", "next",
        as_text(F.col("own_cells")).alias("fingerprint"), as_text(F.col("edited_cells")).alias("edited_fingerprint"),
        *(n.alias(f"apart_{name}") for name, n in apart.items()),
    )
    first = stage(first, "sketches")
    stuck = F.filter(
        F.array(*(F.struct(F.lit(name).alias("pair"), F.col(name).alias("other"), F.col(f"apart_{name}").alias("apart")) for name in apart)),
        lambda pair: pair["apart"].isNull(),
    )
    stuck = first.select("row", "own", F.explode(stuck).alias("p")).select("row", "own", "p.pair", "p.other")
    more = _retried(stuck).groupBy("row").agg(*(F.max(F.when(F.col("pair") == name, F.col("apart"))).alias(f"more_{name}") for name in apart))
    both = first.join(more, "row", "left")

    def near(name: str) -> Column:
        total = F.size("own") + F.size(name)
        different = F.coalesce(f"apart_{name}", f"more_{name}")
        return F.when(total == 0, F.lit(1.0)).otherwise(1 - different / total).alias(f"near_{name}")

    return both.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("edited"), near("next"))
