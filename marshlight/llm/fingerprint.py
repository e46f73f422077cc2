"""Document fingerprints as invertible Bloom lookup sketches. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SMALL = 4  # positions in each of the three parts of the fingerprint's own sketch
ROUNDS = 3


def paragraph_keys(text: Column) -> Column:
    """Distinct 64-bit digests of the text's paragraphs: what line breaks and sentence ends part."""
    parts = F.filter(F.split(text, r"(?<=[.!?])\s+|\n"), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _xor(keys: Column, value) -> Column:
    return F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(value(k)))


def _check(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed + 7)).bitwiseAND(F.lit(0xFFFFFFFF))


def small_sketch(keys: Column) -> Column:
    """The fingerprint: twelve cells (count, exclusive or of keys, of their checks), as base64 of their bytes."""

    def cell(c: int) -> Column:
        mine = F.filter(keys, lambda k: F.shiftrightunsigned(k, 2 * (c // SMALL) + 5).bitwiseAND(F.lit(SMALL - 1)) == F.lit(c % SMALL))
        return F.concat(
            F.lpad(F.hex(F.size(mine).cast("long")), 8, "0"),
            F.lpad(F.hex(_xor(mine, lambda k: k)), 16, "0"),
            F.lpad(F.hex(_xor(mine, lambda k: _check(k, 0))), 8, "0"),
        )

    return F.translate(F.base64(F.unhex(F.concat(*[cell(c) for c in range(3 * SMALL)]))), "\r\n", "")


def _place(key: Column, part: Column | int, seed: int, width: Column) -> Column:
    part = F.lit(part) if isinstance(part, int) else part
    return (part * width + F.pmod(F.xxhash64(key, F.lit(seed) + part), width)).cast("int")


def differences(pairs: DataFrame, ids: list[str], factor: float, least: int, seed: int) -> DataFrame:
    """``ids..., which, found, stuck`` for every pair of key sets ``a`` and ``b`` that differ: the number of keys
    recovered from the difference of their sketches, and whether cells remain that could not be peeled.

    ``pairs`` has the columns ``ids``, ``which``, ``a`` and ``b`` and must be dealt by a subset of ``ids``: then no
    step moves rows. Both sets' cells (three per key, in parts of ``factor`` / 3 times the larger set) are added
    with opposite signs, which subtracts the sketches. Peeling takes the parts in turn: every cell that holds one
    key gives it up, and the key leaves its cells in the other two parts.
    """
    group = [*ids, "which"]
    width = F.greatest(F.lit(least), F.ceil(F.greatest(F.size("a"), F.size("b")) * F.lit(factor / 3))).cast("int")
    sides = F.concat(F.transform("a", lambda k: F.struct(k.alias("k"), F.lit(1).alias("sign"))), F.transform("b", lambda k: F.struct(k.alias("k"), F.lit(-1).alias("sign"))))
    keys = pairs.select(*group, width.alias("w"), F.explode(sides).alias("e")).select(*group, "w", "e.k", "e.sign", _check(F.col("e.k"), seed).alias("c"))
    cells = keys.select(*group, "w", F.explode(F.array(*[_place(F.col("k"), p, seed, F.col("w")) for p in range(3)])).alias("cell"), "sign", "k", "c")
    cells = cells.select(*group, "w", "cell", F.col("sign").alias("n"), "k", "c", F.lit(0).alias("found"))

    def add(df: DataFrame) -> DataFrame:
        got = df.groupBy(*group, "cell").agg(F.max("w").alias("w"), F.sum("n").cast("int").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"), F.sum("found").cast("int").alias("found"))
        return got.filter("n <> 0 OR k <> 0 OR c <> 0 OR found <> 0")

    cells = add(cells)
    zero = F.lit(0).cast("long")
    for step in range(3 * ROUNDS):
        part = step % 3
        pure = (F.col("cell") >= part * F.col("w")) & (F.col("cell") < (part + 1) * F.col("w")) & (F.abs("n") == 1) & (F.col("c") == _check(F.col("k"), seed))
        row = lambda cell, n, k, c, found: F.struct(cell.alias("cell"), n.alias("n"), k.alias("k"), c.alias("c"), found.alias("found"))
        stay = row(F.col("cell"), F.col("n"), F.col("k"), F.col("c"), F.col("found"))
        gone = [row(_place(F.col("k"), p, seed, F.col("w")), -F.col("n"), F.col("k"), F.col("c"), F.lit(0)) for p in range(3) if p != part]
        told = row(F.lit(-1), F.lit(0), zero, zero, F.lit(1))
        moved = cells.select(*group, "w", F.explode(F.when(pure, F.array(told, *gone)).otherwise(F.array(stay))).alias("x"))
        cells = add(moved.select(*group, "w", "x.*"))
    return cells.groupBy(*group).agg(F.sum("found").alias("found"), F.max((F.col("cell") >= 0).cast("int")).alias("stuck"))


KEY = ["none", "id", "t"]


def _own_id(docs: DataFrame) -> Column:
    """The document's id as it was, from ``none`` and ``id``."""
    return F.when(~F.col("none"), F.col("id").cast(docs.schema["doc_id"].dataType))


def with_next_text(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``none, id, t, s, text, head, next_keys, copies`` (t: hash of the text): each row with what it needs of the row
    after it in ascending id order (ties by hash of the text; null ids first; after the last row the first): as many
    first code points as half of its own text, and the digests of its paragraphs. Also ``none, id, t, next_id, next_t``.

    Equal rows follow each other: they are one row here (``s`` 0), and all but the last of them another (``s`` 1) whose
    next text is its own, with their number as ``copies``. Ids and hashes are numbered without the texts, by ranges and
    the ranges' running counts. Texts are dealt by id and hash once; each then sends its head to the row before it, so
    no group of rows grows with the ids' spacing or number. Every reader of the rows takes all their columns, so that
    Spark shuffles the texts once for all of them.
    """
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("text").alias("t"), "text")
    order = [F.col("none").desc(), F.col("id"), F.col("t")]
    ranged = rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.max(F.floor(F.length("text") / 2)).cast("int").alias("half"))
    ranged, _ = materialize(ranged.repartitionByRange(shuffles, *order).withColumn("p", F.spark_partition_id()), "ranged")
    # one row per range
    counts = ranged.groupBy("p").agg(F.count("*").alias("size"))
    starts = counts.select("p", (F.sum("size").over(Window.orderBy("p")) - F.col("size")).alias("start"))
    total = ranged.count()
    place = F.col("start") + F.row_number().over(Window.partitionBy("p").orderBy(*order)) - 1
    numbered, _ = materialize(ranged.join(F.broadcast(starts), "p").select(*KEY, "n", "half", place.alias("at")), "numbered")
    before = numbered.select(F.pmod(F.col("at") + 1, F.lit(max(1, total))).alias("at"), F.struct(*KEY).alias("to"), F.col("half").alias("ask"))
    behind = numbered.select(F.pmod(F.col("at") - 1, F.lit(max(1, total))).alias("at"), _own_id(docs).alias("next_id"), F.col("t").alias("next_t"))
    links, _ = materialize(numbered.join(before, "at").join(behind, "at").select(*KEY, "n", "to", "ask", "next_id", "next_t"), "links")
    met = rows.groupBy(*KEY).agg(F.first("text").alias("text")).join(links.select(*KEY, "n", "to", "ask"), KEY)
    sent = met.select("to.*", F.substring("text", F.lit(1), F.col("ask")).alias("head"), paragraph_keys(F.col("text")).alias("next_keys"))
    after = met.drop("to", "ask").join(sent, KEY)
    last = F.struct(F.lit(0).alias("s"), F.col("head").alias("x"), F.col("next_keys").alias("k"), F.lit(1).cast("long").alias("c"))
    inner = F.struct(F.lit(1).alias("s"), F.col("text").alias("x"), paragraph_keys(F.col("text")).alias("k"), (F.col("n") - 1).alias("c"))
    out = after.withColumn("e", F.explode(F.when(F.col("n") > 1, F.array(last, inner)).otherwise(F.array(last))))
    return out.select(*KEY, "e.s", "text", F.col("e.x").alias("head"), F.col("e.k").alias("next_keys"), F.col("e.c").alias("copies")), links.select(*KEY, "next_id", "next_t")


def _edited(text: str = "text", head: str = "head") -> Column:
    half = f"CAST(floor(length({text}) / 2) AS INT)"
    return F.concat(F.expr(f"substring({text}, 1, length({text}) - {half})"), F.expr(f"substring({head}, 1, {half})"))


def _pairs(texts: DataFrame, ids: list[str], which: Column | None = None) -> DataFrame:
    """Key sets of each text and of the edited (0) and the next (1) text, one row per pair."""
    two = F.array(F.struct(F.lit(0).alias("which"), paragraph_keys(_edited()).alias("b")), F.struct(F.lit(1).alias("which"), F.col("next_keys").alias("b")))
    rows = texts.select(*ids, paragraph_keys(F.col("text")).alias("a"), F.explode(two).alias("p"), *([which.alias("want")] if which is not None else []))
    if which is not None:
        rows = rows.filter(F.col("want") == F.col("p.which"))
    return rows.select(*ids, "p.which", "a", "p.b")


def _texts_of(docs: DataFrame, places: DataFrame, id_col: str, hash_col: str, name: str, small: int = 200_000) -> DataFrame:
    """``places`` with the texts of their documents: broadcast while there are few."""
    want = places.select(F.col(id_col).alias("_id"), F.col(hash_col).alias("_h")).distinct()
    want = F.broadcast(want) if want.count() <= small else want
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_t", F.xxhash64("text"))
    rows = rows.join(want, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_h"))).dropDuplicates(["_id", "_h"])
    rows = rows.select("_id", "_h", F.col("text").alias(name))
    return places.join(rows, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col(hash_col) == F.col("_h"))).drop("_id", "_h")


def fingerprints(docs: DataFrame, factor: float = 9.0, least: int = 96) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, with the number
    of paragraphs, and of differing ones to either, as ``paragraphs, apart_edited, apart_next``.

    The edited text has its last floor(n/2) code points replaced by as many (or all) first ones of the next text.
    The likeness of two fingerprints is 1 less the share of differing paragraphs among both texts' (1 for two
    empty texts). Both texts are sketched at ``factor`` cells per paragraph (3 * ``least`` at least), the sketches
    subtracted and the difference peeled; where that fails, at twice the size under other hashes, again and
    again. The fingerprint that is returned is the text's sketch of twelve cells.

    Null texts are empty; a paragraph that repeats within a text counts once; a lone document is its own next;
    repeated rows follow each other; an empty table gives no rows; other columns are not carried. Ids must be
    whole numbers.
    """
    ids = [*KEY, "s"]
    n = F.length("text").cast("long")
    base, links = with_next_text(docs)
    rows = base.select(
        *ids, "copies", n.alias("n_chars"), F.sha2(_edited().cast("binary"), 256).alias("edited_sha256"),
        paragraph_keys(F.col("text")).alias("a"), paragraph_keys(_edited()).alias("e"), F.size("next_keys").alias("nx"),
    )
    rows = rows.withColumns({"fingerprint": small_sketch(F.col("a")), "edited_fingerprint": small_sketch(F.col("e")), "na": F.size("a"), "ne": F.size("e")}).drop("a", "e")
    # both parts read one shuffle of the texts and are written together
    both, _ = materialize(rows.unionByName(differences(_pairs(base, ids), ids, factor, least, 100), allowMissingColumns=True), "likeness")
    rows, found = both.filter("fingerprint IS NOT NULL"), both.filter("fingerprint IS NULL").select(*ids, "which", "found", "stuck")
    parts, stuck = [found.filter("stuck = 0").select(*ids, "which", "found")], found.filter("stuck = 1")
    for turn in range(1, 40):
        if not stuck.limit(1).count():
            break
        factor, least = factor * 2, least * 2
        own = F.col("s") == 1  # the row after is equal
        after = [F.when(own, x).otherwise(F.col(c)).alias(c) for c, x in (("next_id", _own_id(docs)), ("next_t", F.col("t")))]
        places = stuck.select(*ids, "which").join(links, KEY).select(*ids, "which", _own_id(docs).alias("doc_id"), *after)
        texts = _texts_of(docs, _texts_of(docs, places, "doc_id", "t", "text"), "next_id", "next_t", "head").withColumn("next_keys", paragraph_keys(F.col("head")))
        again, _ = materialize(_pairs(texts, ids, F.col("which")), "pairs")
        dealt = again.repartition(*ids)
        tried, _ = materialize(differences(dealt, ids, factor, least, 100 + 10 * turn), "retry")
        parts.append(tried.filter("stuck = 0").select(*ids, "which", "found"))
        stuck = tried.filter("stuck = 1")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    wide = found.groupBy(*ids).agg(*[F.max(F.when(F.col("which") == i, F.col("found"))).alias(f"d{i}") for i in (0, 1)])
    done = rows.join(wide, ids, "left").withColumns({f"d{i}": F.coalesce(f"d{i}", F.lit(0)) for i in (0, 1)})  # no cell left: nothing differs
    like = lambda d, m: F.when(F.col("na") + F.col(m) > 0, 1 - F.col(d) / (F.col("na") + F.col(m))).otherwise(1.0)
    return done.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        _own_id(docs).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", like("d0", "ne").alias("near_edited"), like("d1", "nx").alias("near_next"),
        F.col("na").alias("paragraphs"), F.col("d0").cast("long").alias("apart_edited"), F.col("d1").cast("long").alias("apart_next"),
    )
