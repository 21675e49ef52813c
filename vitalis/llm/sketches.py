"""Document fingerprints: invertible Bloom lookup sketches of digests of paragraphs or their pieces.

A sketch is a row of cells; each digest is added to three of them (a count, the xor of digests,
the xor of their check hashes). Two sketches subtract cell by cell, and peeling cells that hold
one digest recovers the digests by which two documents differ. Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, stage, width

CELLS = 24  # of a fingerprint
SECTION = 4  # digests of each side that one sketch of a comparison takes on average
SPLIT = 256  # sections that a document is cut into within its row; longer ones are dealt by a shuffle
PEELS = 12  # rounds of peeling before a sketch counts as failed
_LEAST = -(2**63)

_ENDS = "dhlptxDHLPTX048.!?;:"  # a piece may end after a word that ends with one of these
_BANDS = "".join(rf"\u{b:02X}{low}0-\u{b:02X}{low}F" for b in range(1, 256) if not 0xD8 <= b <= 0xDF for low in "26")


def _piece(least: int, wide: int, most: int) -> str:
    """A piece of a line: ``least`` to ``wide`` characters up to the first word of a certain ending; without one, up to a
    character of certain code points (text without spaces); without any, ``most`` characters or what is left."""
    return (
        rf"[^\n]{{{least - 1},{wide - 2}}}?[{_ENDS}][ \t]|[^\n]{{{least - 1},{most - 2}}}?(?:[{_ENDS}]|(?![\x00-\x7F])[{_BANDS}])|[^\n]{{1,{most}}}"
    )


FIRST = 96  # characters of a document that are cut into a few words each; what follows is cut more coarsely
WORDS, LONGER = r"[^\n]{7,22}?[ \t]|[^\n]{1,24}", _piece(140, 300, 400)


def digests(text: Column, pieces: bool = False) -> Column:
    """The distinct digests of a text's paragraphs (lines that aren't empty), or of their pieces.

    The cuts between pieces depend on the characters around them, so that an edit inside a line
    changes the pieces it touches and few after them. Short documents have small pieces, as documents begin with them.
    """

    def lines(text: Column) -> Column:
        return F.filter(F.split(text, "\n", -1), lambda p: p != "")

    def pieces_of(text: Column, pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def parts(text: Column) -> Column:
        if not pieces:
            return lines(text)
        return F.concat(pieces_of(text.substr(1, FIRST), WORDS), pieces_of(text.substr(FIRST + 1, 2**31 - 1), LONGER))

    parts = F.element_at(F.transform(F.array(text), parts), 1)  # a lambda's argument is computed once
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _entry(key: Column, sign: Column, cells: Column) -> Column:
    """A digest with its check hash and its cell in each third of the sketch."""
    third = F.floor(cells / 3).cast("int")
    at = [(F.pmod(F.xxhash64(key, F.lit(s)), third) + third * s).cast("int").alias(f"p{s}") for s in range(3)]
    return F.struct(key.alias("k"), F.xxhash64(key, F.lit(99)).alias("x"), sign.cast("int").alias("n"), *at)


def _add(cells: Column, entry: Column) -> Column:
    def one(cell: Column, i: Column) -> Column:
        hit = (i == entry["p0"]) | (i == entry["p1"]) | (i == entry["p2"])
        changed = F.struct(
            (cell["n"] + entry["n"]).alias("n"), cell["k"].bitwiseXOR(entry["k"]).alias("k"), cell["x"].bitwiseXOR(entry["x"]).alias("x")
        )
        return F.when(hit, changed).otherwise(cell)

    return F.transform(cells, one)


def _empty(cells: Column) -> Column:
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("x"))
    return F.array_repeat(zero, cells.cast("int"))


def sketch(keys: Column, cells: Column, sign: int = 1) -> Column:
    """The sketch of an array of distinct digests."""
    entries = F.transform(keys, lambda k: _entry(k, F.lit(sign), cells))
    return F.aggregate(entries, _empty(cells), _add)


def subtract(a: Column, b: Column) -> Column:
    """Cell by cell: what both documents hold cancels out."""
    return F.zip_with(
        a, b, lambda x, y: F.struct(
            (x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["x"].bitwiseXOR(y["x"]).alias("x")
        )
    )


def peel(cells: Column, size: Column) -> Column:
    """struct(cells left, found, more): ``found`` has each recovered digest ``k`` with the sign ``n`` of its side."""

    def round_(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (F.xxhash64(c["k"], F.lit(99)) == c["x"]))
        pure = F.array_distinct(F.transform(pure, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"))))

        def take(pure: Column) -> Column:
            removed = F.aggregate(F.transform(pure, lambda p: _entry(p["k"], -p["n"], size)), state["cells"], _add)
            return F.struct(removed.alias("cells"), F.concat(state["found"], pure).alias("found"), (F.size(pure) > 0).alias("more"))

        once = F.transform(F.array(pure), take)  # a lambda's argument is computed once
        return F.when(state["more"], F.element_at(once, 1)).otherwise(state)

    none = F.array().cast("array<struct<k:bigint,n:int>>")
    start = F.struct(cells.alias("cells"), none.alias("found"), F.lit(True).alias("more"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(PEELS)), start, round_)


def as_text(cells: Column) -> Column:
    """A sketch as a string: count, digest and check of each cell in hexadecimal."""
    shown = F.transform(cells, lambda c: F.when(c["n"] == 0, F.lit("")).otherwise(F.concat_ws(",", c["n"].cast("string"), F.hex(c["k"]), F.hex(c["x"]))))
    return F.array_join(shown, ";")


def _marked(keys: str, side: int) -> Column:
    return F.transform(keys, lambda k: F.struct(k.alias("k"), F.lit(side).alias("s")))


def _signed(found: str, sign: int) -> Column:
    return F.transform(F.filter(found, lambda e: e["n"] == sign), lambda e: e["k"])


def differences(pairs: DataFrame, listed: bool = True) -> DataFrame:
    """Per (row, pair): the digests only in array ``a`` (``removed``) and only in ``b`` (``added``).
    Without ``listed``, how many both are (``apart``). Pairs without any have no row.

    ``expected`` is the share of digests that may differ, which sets the first sketch's size. A
    pair of many digests is split by hash into sections with a sketch each, so that work grows in
    proportion. A sketch that can't be peeled is made twice as large, until every one is.
    """
    total = F.size("a") + F.size("b")
    pairs = pairs.withColumn("sections", F.greatest(F.lit(1), F.ceil(total / F.lit(2 * SECTION)).cast("int")))

    def section_of(key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(7)), F.col("sections")).cast("int")

    def chosen(place: Column, rule) -> list[Column]:
        return [F.filter(place[c], rule).alias(c) for c in "ab"]

    def parts(wide: Column) -> Column:
        """Sections in two steps: first groups of ``wide`` sections, then the sections of each group."""

        def sections(group: Column, g: Column) -> Column:
            last = F.least(F.col("sections"), (g + 1) * wide) - 1
            return F.transform(F.sequence(g * wide, last), lambda s: F.struct(s.alias("section"), *chosen(group, lambda e: e["s"] == s)))

        dealt = F.struct(*(F.transform(c, lambda k: F.struct(k.alias("k"), section_of(k).alias("s"))).alias(c) for c in "ab"))
        groups = F.transform(F.array(dealt), lambda d: F.transform(
            F.sequence(F.lit(0), F.ceil(F.col("sections") / wide).cast("int") - 1),
            lambda g: F.struct(g.alias("g"), *chosen(d, lambda e: F.floor(e["s"] / wide) == g)),
        ))
        return F.flatten(F.transform(F.element_at(groups, 1), lambda x: sections(x, x["g"])))

    keys = [F.transform(f"part.{c}", lambda e: e["k"]).alias(c) for c in "ab"]
    small = pairs.filter("sections = 1").select("row", "pair", F.lit(0).alias("section"), "expected", "a", "b")
    middle = pairs.filter(f"sections BETWEEN 2 AND {SPLIT}").withColumn("wide", F.ceil(F.sqrt("sections")).cast("int"))
    middle = middle.select("row", "pair", "expected", F.explode(parts(F.col("wide"))).alias("part"))
    small = small.unionByName(middle.select("row", "pair", "part.section", "expected", *keys))
    sides = F.concat(*(_marked(c, s) for s, c in enumerate("ab")))
    large = pairs.filter(f"sections > {SPLIT}").select("row", "pair", "expected", "sections", F.explode(sides).alias("e"))
    section = section_of("e.k")
    large = large.groupBy("row", "pair", section.alias("section"), "expected").agg(
        *(F.sort_array(F.collect_list(F.when(F.col("e.s") == s, F.col("e.k")))).alias(c) for s, c in enumerate("ab"))
    )
    differ = (F.size("a") + F.size("b")) * F.col("expected")
    first = (F.ceil((differ * 2 + 2) / 3) * 3).cast("int")
    work = small.unionByName(large).filter("a <> b").withColumn("size", first)  # equal sections cancel out whole
    found = F.col("peeled.found") if listed else F.size("peeled.found").alias("found")
    done = None
    while True:
        cells = subtract(sketch(F.col("a"), F.col("size")), sketch(F.col("b"), F.col("size")))
        tried = work.withColumn("peeled", peel(cells, F.col("size")))
        clear = F.forall("peeled.cells", lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["x"] == 0))
        tried = stage(tried.select("row", "pair", "section", "expected", "size", F.when(~clear, F.col("a")).alias("a"),
                                   F.when(~clear, F.col("b")).alias("b"), clear.alias("clear"), found), "peeled")
        good = tried.filter("clear").select("row", "pair", "found")
        done = good if done is None else done.unionByName(good)
        work = tried.filter("NOT clear").select("row", "pair", "section", "expected", "a", "b", (F.col("size") * 2).alias("size"))
        if work.isEmpty():
            break
    if not listed:
        return done.groupBy("row", "pair").agg(F.sum("found").alias("apart"))
    parts = done.select("row", "pair", _signed("found", 1).alias("removed"), _signed("found", -1).alias("added"))
    return parts.groupBy("row", "pair").agg(*(F.flatten(F.collect_list(n)).alias(n) for n in ("removed", "added")))


def with_next(docs: DataFrame) -> DataFrame:
    """(id, text, next text) in ascending id, the last followed by the first; ties by text.

    Rows go to buckets of neighbouring ids. The first row of each bucket is also dealt to the
    bucket before, so that one shuffle and a window within buckets find every next text.
    """
    wanted = 4 * width(docs.sparkSession)
    docs = docs.withColumn("place", F.coalesce("id", F.lit(_LEAST)))
    found = docs.agg(F.percentile_approx("place", [i / wanted for i in range(1, wanted)], 10_000)).first()[0] or []
    cuts = F.array(*(F.lit(c).cast("long") for c in sorted(set(found)))) if found else F.array().cast("array<bigint>")
    docs = docs.withColumn("bucket", F.size(F.filter(cuts, lambda c: c <= F.col("place"))))
    heads = docs.groupBy("bucket").agg(F.min("place").alias("head")).orderBy("bucket").collect()  # a row for each bucket
    if not heads:
        return docs.select("id", "text", F.col("text").alias("following"))
    bucket_before = {r["bucket"]: heads[k - 1]["bucket"] for k, r in enumerate(heads)}
    n = heads[-1]["bucket"] + 1
    first = {r["bucket"]: r["head"] for r in heads}
    head_of = F.element_at(F.array(*(F.lit(first.get(b)).cast("long") for b in range(n))), F.col("bucket") + 1)
    before = F.element_at(F.array(*(F.lit(bucket_before.get(b)).cast("int") for b in range(n))), F.col("bucket") + 1)
    own = F.struct(F.col("bucket").cast("int").alias("at"), F.lit(0).alias("ghost"))
    ghost = F.struct(before.alias("at"), F.lit(1).alias("ghost"))
    dealt = docs.select("id", "place", "text", F.inline(F.when(F.col("place") == head_of, F.array(own, ghost)).otherwise(F.array(own))))
    order = Window.partitionBy("at").orderBy("ghost", "place", "text")
    return dealt.withColumn("following", F.lead("text").over(order)).filter("ghost = 0").select("id", "text", "following")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pieces: bool = False) -> DataFrame:
    """Each document, its edited text's hash, both fingerprints, and how alike they are.

    The edited text ends with as many characters of the next document as its second half has.
    Likeness is the share of common among all digests (of paragraphs, or with ``pieces`` of their
    pieces), 1 where neither has any, from the digests that peeling recovers. Null texts are empty texts. Repeated rows follow each other;
    a null id stands before all others. A single document is its own next one; an empty table
    gives an empty result. Other columns don't matter.
    """
    slim = fresh_columns(docs, id=id_col, text=text_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - half), F.col("following").substr(F.lit(1), half))
    known = with_next(slim).withColumn("edited", edited)
    known = known.select(
        F.monotonically_increasing_id().alias("row"), "id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        *(digests(F.col(c), pieces).alias(n) for c, n in (("text", "own"), ("edited", "changed"), ("following", "following"))),
    )
    known = stage(known, "digests")
    each = F.array(
        F.struct(F.lit(0).alias("pair"), F.lit(0.5).alias("expected"), F.col("own").alias("a"), F.col("changed").alias("b")),
        F.struct(F.lit(1).alias("pair"), F.lit(1.0).alias("expected"), F.col("own").alias("a"), F.col("following").alias("b")),
    )
    found = differences(known.select("row", F.inline(each)), listed=False)
    counted = found.groupBy("row").agg(*(F.sum(F.when(F.col("pair") == p, F.col("apart"))).alias(f"apart{p}") for p in range(2)))
    joined = known.join(counted, "row", "left").fillna(0, ["apart0", "apart1"])

    def alike(other: str, apart: str) -> Column:
        both = F.size("own") + F.size(other)
        return F.when(both == 0, F.lit(1.0)).otherwise((both - F.col(apart)) / (both + F.col(apart)))

    size = F.lit(CELLS)
    return joined.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", as_text(sketch(F.col("own"), size)).alias("fingerprint"),
        as_text(sketch(F.col("changed"), size)).alias("edited_fingerprint"),
        alike("changed", "apart0").alias("near_edited"), alike("following", "apart1").alias("near_next"),
    )
