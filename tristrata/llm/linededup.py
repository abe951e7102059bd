"""Line deduplication over content-defined chunks, with DataFrame functions only.

A rolling hash over the hashes of a line and the one before it decides whether a chunk
ends there, so boundaries move with the text. A chunk ends where it is even, after two
lines on average; with an odd base that bit is the last bits of both hashes, added. Lines of LONG_LINE words or more are chunks
of their own. Chunks are grouped by digest and by their bytes; every occurrence but the
first (least doc_id, then place) is repeated. Neighbouring repeated chunks of a document
form a passage; it is removed if it has two lines and LEAST_WORDS words, or LONG_LINE
words.

Chunk borders can cut a passage where it meets foreign lines. Unless ``runs`` is off, the exact
step ``repeated_runs`` also removes every run of lines of LONG_LINE words that stands earlier as
it is, whatever its borders: each line opens and closes one shortest run of that many words,
and the repeated shortest runs cover exactly the lines of all repeated longer ones.

Line hashes are counted first: a chunk or run can only repeat if all its lines do, so texts
without enough neighbouring repeated lines are done and only the others are cut and compared.

Inside, every line carries a tag: B where a chunk begins, C elsewhere. A line break is
always followed by a tag, so chunks can be split and joined as strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize, materialize_alone

LONG_LINE = 50
LEAST_WORDS = 20
CELLS = 1 << 26
WORD = r"[^\x20\x09-\x0D]+"


def _shifted(values: Column, first: Column) -> Column:
    return F.concat(F.array(first), F.slice(values, 1, F.greatest(F.size(values) - 1, F.lit(0))))


def _is_long(line: Column) -> Column:
    """LONG_LINE words need as many letters and a space between each two."""
    return (F.length(line) >= 2 * LONG_LINE - 1) & (F.regexp_count(line, F.lit(WORD)) >= LONG_LINE)


def _is_odd(line: Column) -> Column:
    """The last bit of a line's hash (the first 32 bits of its md5)."""
    return F.instr(F.lit("13579bdf"), F.substring(F.md5(line.cast("binary")), 8, 1)) > 0


def with_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``print``, a hash of the text, and its tagged ``chunks``; null texts have none."""
    lines = docs.withColumn("lines", F.split("text", "\n", -1))
    hashed = lines.select(
        "*",
        F.transform("lines", _is_odd).alias("odd"),
        F.transform("lines", _is_long).alias("long"),
    )
    ended = hashed.select(
        "*", F.zip_with("odd", _shifted(F.col("odd"), F.lit(False)), lambda a, b: a == b).alias("ends")
    )
    begins = F.zip_with(
        F.zip_with(_shifted(F.col("ends"), F.lit(True)), _shifted(F.col("long"), F.lit(False)), lambda a, b: a | b), F.col("long"), lambda a, b: a | b
    )
    tagged = F.array_join(F.zip_with(begins, F.col("lines"), lambda b, x: F.concat(F.when(b, "B").otherwise("C"), x)), "\n")
    return ended.select("doc_id", "text", F.xxhash64("text").alias("print"), F.split(tagged, "\n(?=B)", -1).alias("chunks"))


def plain(chunk: Column) -> Column:
    """A chunk without its tags."""
    return F.regexp_replace(F.substring(chunk, 2, F.length(chunk)), "\nC", "\n")


def repeated_chunks(chunked: DataFrame) -> DataFrame:
    """(digest, lines, words) of chunks that occur more than once, equal byte by byte.

    Grouping by the chunk itself compares bytes. A digest shared by different chunks is
    left out: none of them is removed.
    """
    # An expression, not a column: the planner filters the rows by a column that is exploded and so computes it three times.
    named = F.transform("chunks", lambda c: F.struct(F.md5(c.cast("binary")).alias("digest"), c.alias("chunk")))
    texts = chunked.select(F.explode(named).alias("named")).groupBy("named.digest", "named.chunk").agg(F.count(F.lit(1)).alias("times"))
    counted = lambda c, pattern: F.when(F.col("times") > 1, F.regexp_count(c, F.lit(pattern)))
    narrow = texts.select(
        "digest", "times",
        counted(F.col("chunk"), r"(^|\n)[BC](?=[^\n]*[^\x20\x09-\x0D])").alias("lines"),
        counted(plain(F.col("chunk")), WORD).alias("words"),
    )
    return (
        narrow.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("texts"), F.max("times").alias("times"), F.max("lines").alias("lines"), F.max("words").alias("words"))
        .where("texts = 1 and times > 1")
        .select("digest", "lines", "words")
    )


def removals(chunked: DataFrame) -> DataFrame:
    """(doc_id, print, gone): places of the chunks that each document loses."""
    places = chunked.select("doc_id", "print", F.posexplode(F.transform("chunks", lambda c: F.md5(c.cast("binary")))).alias("idx", "digest"))
    again = materialize(repeated_chunks(chunked), "repeated-chunks")
    found = materialize(places.join(again, "digest"), "repeated-places")
    first = found.groupBy("digest").agg(F.min(F.struct("doc_id", "print", "idx")).alias("first"))
    mine = F.struct("doc_id", "print", "idx")
    found = found.join(first, "digest").where(~mine.eqNullSafe(F.col("first"))).select("doc_id", "print", "idx", "lines", "words").distinct()
    order = Window.partitionBy("doc_id", "print").orderBy("idx")
    passage = Window.partitionBy("doc_id", "print", "run")
    return (
        found.withColumn("run", F.col("idx") - F.row_number().over(order))
        .withColumn("run_lines", F.sum("lines").over(passage))
        .withColumn("run_words", F.sum("words").over(passage))
        .where(f"(run_lines >= 2 and run_words >= {LEAST_WORDS}) or run_words >= {LONG_LINE}")
        .groupBy("doc_id", "print")
        .agg(F.collect_list("idx").alias("gone"))
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often its inner functions ask for it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shortest_runs(text: Column) -> Column:
    """(at, size, key) of the shortest runs of LONG_LINE words from and up to each line with words.

    Places and sizes count all lines; key is a hash. A line of LONG_LINE words has no run
    of its own: it is a chunk already.
    """

    def long_enough(part: Column) -> Column:
        """Lines of ``part`` up to LONG_LINE words, 0 if one is enough or all are not."""
        none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"))
        more = lambda a, s: F.when(a.words >= LONG_LINE, a).otherwise(F.struct((a.words + s.words).alias("words"), (a.n + 1).alias("n")))
        return F.aggregate(part, none, more, lambda a: F.when((a.words >= LONG_LINE) & (a.n > 1), a.n).otherwise(0))

    def runs(lines: Column) -> Column:
        # Every line here has a word, so LONG_LINE of them are always enough. A run is first line * 64 + lines.
        ahead = F.transform(lines, lambda s, j: _let(long_enough(F.slice(lines, j + 1, LONG_LINE)), lambda n: F.when(n > 0, j.cast("bigint") * 64 + n)))
        start = lambda j: F.greatest(j - (LONG_LINE - 2), F.lit(1))
        behind = F.transform(
            lines,
            lambda s, j: _let(
                long_enough(F.reverse(F.slice(lines, start(j), j + 2 - start(j)))), lambda n: F.when(n > 0, (j - n + 1).cast("bigint") * 64 + n)
            ),
        )
        found = F.filter(F.array_union(ahead, behind), lambda c: c.isNotNull())
        part = lambda c: F.slice(lines, F.floor(c / 64).cast("int") + 1, (c % 64).cast("int"))
        size = lambda p: F.element_at(p, -1).at - F.element_at(p, 1).at + 1
        return F.transform(
            found,
            lambda c: _let(
                part(c),
                lambda p: F.struct(F.element_at(p, 1).at.alias("at"), size(p).alias("size"), F.xxhash64(F.transform(p, lambda s: s.hash), size(p)).alias("key")),
            ),
        )

    lines = F.transform(
        F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("at"), F.regexp_count(x, F.lit(WORD)).alias("words"), F.xxhash64(x).alias("hash"))
    )
    return _let(F.filter(lines, lambda s: s.words > 0), runs)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, print, runs): places and sizes of the shortest runs of lines that stand earlier in ``docs`` (doc_id, text).

    A hash only proposes runs; their bytes decide. A run is repeated if its first
    occurrence (least doc_id, then place) ends before it, so overlapping copies of a line
    leave one whole. A digest shared by different runs is left out.
    """
    seen = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("print"), F.explode(_shortest_runs(F.col("text"))).alias("r"))
    seen = materialize(seen.select("doc_id", "print", "r.*"), "line-runs")
    again = seen.groupBy("key").count().where("count > 1").select("key")
    asked = seen.join(again, "key", "left_semi").groupBy("doc_id", "print").agg(F.collect_set(F.struct("at", "size")).alias("asked"))
    asked = materialize(asked, "asked-runs")
    # One grouping drops repeated rows and brings a text and its runs together, so texts move once, and only those asked for.
    texts = docs.select("doc_id", F.xxhash64("text").alias("print"), "text", F.lit(None).cast(asked.schema["asked"].dataType).alias("asked"))
    texts = _marked(texts, ["doc_id", "print"], asked, ["doc_id", "print"]).where("marked").drop("marked")
    both = texts.unionByName(asked.select("doc_id", "print", F.lit(None).cast("string").alias("text"), "asked"))
    cut = (
        both.groupBy("doc_id", "print").agg(F.first("text", ignorenulls=True).alias("text"), F.first("asked", ignorenulls=True).alias("asked"))
        .where("asked is not null")
        .select(
            "doc_id", "print",
            F.explode(
                _let(
                    F.split("text", "\n", -1),
                    lambda lines: F.transform("asked", lambda r: F.struct(r.at.alias("at"), r.size.alias("size"), F.array_join(F.slice(lines, r.at + 1, r.size), "\n").alias("run"))),
                )
            ).alias("r"),
        )
        .select("doc_id", "print", "r.*", F.md5(F.col("r.run").cast("binary")).alias("digest"))
    )
    cut = materialize(cut, "run-texts")
    place = F.struct("doc_id", "print", "at")
    first = (
        cut.groupBy("digest", "run").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
        .groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.max("times").alias("times"))
        .where("texts = 1 and times > 1").select("digest", "first")
    )
    elsewhere = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("print") == F.col("first.print")))
    return (
        cut.select("doc_id", "print", "at", "size", "digest").join(first, "digest")
        .where(elsewhere | (F.col("at") >= F.col("first.at") + F.col("size")))
        .groupBy("doc_id", "print").agg(F.collect_list(F.struct("at", "size")).alias("runs"))
    )


def _without(gone: Column, runs: Column, chunks: Column, text: Column) -> Column:
    """The lines of ``text`` outside the chunks ``gone`` and outside ``runs``."""
    doomed = F.flatten(F.transform(chunks, lambda c, i: F.array_repeat(F.array_contains(gone, i), _breaks(c))))
    by_chunk = F.filter(F.transform(doomed, lambda d, i: F.when(d, i)), lambda i: i.isNotNull())
    by_run = F.flatten(F.transform(runs, lambda r: F.sequence(r.at, r.at + r.size - 1)))
    left = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.concat(by_chunk, by_run))
    return _let(F.split(text, "\n", -1), lambda lines: F.transform(left(lines), lambda i: F.get(lines, i)))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, print, pos, key, chars) of the lines with words of ``docs`` (doc_id, text), numbered among those."""
    shape = lambda x: F.struct(F.xxhash64(x).alias("key"), F.length(x).alias("chars"), (F.btrim(x, F.lit(" \t\n\x0b\f\r")) == "").alias("blank"))
    lines = F.filter(F.transform(F.split("text", "\n", -1), shape), lambda s: ~s.blank)
    placed = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("print"), F.posexplode(lines).alias("pos", "line"))
    return placed.select("doc_id", "print", "pos", "line.key", "line.chars")


def suspects(docs: DataFrame) -> DataFrame:
    """(doc_id, print) of the texts that may lose lines: neighbouring lines that all occur twice could hold words enough."""
    lines = materialize(_lines(docs), "line-hashes")
    again = lines.groupBy("key").count().where("count > 1").select("key")
    held = lines.join(again, "key").groupBy("doc_id", "print").agg(F.sort_array(F.collect_set(F.struct("pos", "chars"))).alias("held"))
    none = F.struct(F.lit(-9).alias("pos"), F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("chars"), F.lit(False).alias("enough"))

    def step(a: Column, s: Column) -> Column:
        joins = s.pos == a.pos + 1
        n, chars = F.when(joins, a.n + 1).otherwise(1), F.when(joins, a.chars + s.chars + 1).otherwise(s.chars.cast("bigint"))
        # So many words need as many letters and a space between each two.
        enough = a.enough | ((n >= 2) & (chars >= 2 * LEAST_WORDS - 1)) | (chars >= 2 * LONG_LINE - 1)
        return F.struct(s.pos.alias("pos"), n.alias("n"), chars.alias("chars"), enough.alias("enough"))

    return held.where(F.aggregate("held", none, step, lambda a: a.enough)).select("doc_id", "print")


def _marked(rows: DataFrame, by: list[str], keys: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with ``marked``: true wherever ``by`` equals the ``names`` of a row of ``keys``, and by chance elsewhere.

    A bitmap of CELLS bits, 8 MB in 4 KB parts whatever the input, is all that is broadcast.
    """
    cell = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(CELLS))
    bits = keys.groupBy(F.bitmap_bucket_number(cell(names)).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell(names))).alias("bits"))
    place = F.bitmap_bit_position(cell(by))
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("bucket", F.bitmap_bucket_number(cell(by))).join(F.broadcast(bits), "bucket", "left")
    return found.withColumn("marked", F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))).drop("bucket", "bits")


def _stripped(docs: DataFrame, runs: bool) -> DataFrame:
    """(row, gone, text, n_lost): the rows as they are, what they lose, what is left and how many lines go."""
    spark = docs.sparkSession
    keys = materialize_alone(spark, "suspect-keys", lambda: suspects(docs.select("doc_id", "text")).withColumnsRenamed({"doc_id": "of", "print": "of_print"}))
    rows = docs.select(F.struct("*").alias("row")).withColumn("row_print", F.xxhash64("row.text"))
    rows = _marked(rows, ["row.doc_id", "row_print"], keys, ["of", "of_print"])
    # What else shares the cells of suspects is told apart by names; a second bitmap finds it, and only the texts marked there move.
    marked = rows.where("marked").drop("marked")
    names = marked.select(F.col("row.doc_id").alias("name"), F.col("row_print").alias("name_print")).distinct()
    others = names.join(keys, F.col("name").eqNullSafe(F.col("of")) & (F.col("name_print") == F.col("of_print")), "left_anti")
    others = materialize(others, "chance-marked")
    marked = _marked(marked, ["row.doc_id", "row_print"], others, ["name", "name_print"])
    known = F.col("row.doc_id").eqNullSafe(F.col("name")) & (F.col("row_print") == F.col("name_print"))
    doubtful = marked.where("marked").join(others.withColumn("other", F.lit(True)), known, "left")
    doubtful = materialize(doubtful.select("row", F.coalesce("other", F.lit(False)).alias("other")), "doubtful")
    found = materialize(marked.where("not marked").select("row").union(doubtful.where("not other").select("row")), "suspects")
    cut = (_cut_runs if runs else _cut_chunks)(found.select("row.*"))
    clean = rows.where("not marked").select("row").union(doubtful.where("other").select("row"))
    clean = clean.select("row", F.lit(None).cast(cut.schema["gone"].dataType).alias("gone"), "row.text", F.lit(0).alias("n_lost"))
    return clean.union(cut.select("row", "gone", "text", "n_lost"))


def _cut_runs(docs: DataFrame) -> DataFrame:
    """(row, gone, text, n_lost): as ``_cut_chunks``, the lines of ``repeated_runs`` gone as well."""
    found = docs.select("doc_id", "text")

    def lost() -> DataFrame:
        chunks, runs = removals(with_chunks(found)), repeated_runs(found)
        return (
            chunks.select("doc_id", "print", "gone", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs"))
            .unionByName(runs.select("doc_id", "print", F.lit(None).cast(chunks.schema["gone"].dataType).alias("gone"), "runs"))
            .groupBy(F.col("doc_id").alias("of"), F.col("print").alias("of_print"))
            .agg(F.flatten(F.collect_list("gone")).alias("gone"), F.flatten(F.collect_list("runs")).alias("runs"))
        )

    keys = materialize_alone(docs.sparkSession, "lost-lines", lost)
    rows = docs.select(F.struct("*").alias("row")).withColumn("row_print", F.xxhash64("row.text"))
    rows = _marked(rows, ["row.doc_id", "row_print"], keys, ["of", "of_print"])
    joined = rows.where("marked").join(keys, F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.col("row_print") == F.col("of_print")), "left")
    cut = with_chunks(joined.select(F.struct("row", "gone", "runs").alias("doc_id"), F.when(F.col("gone").isNotNull(), F.col("row.text")).alias("text")))
    kept = cut.select("doc_id.row", "doc_id.gone", _without(F.col("doc_id.gone"), F.col("doc_id.runs"), F.col("chunks"), F.col("text")).alias("kept"))
    lost_some = kept.select(
        "row", "gone",
        F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join("kept", "\n")).alias("text"),
        F.when(F.col("gone").isNull(), 0).otherwise(_breaks(F.col("row.text")) - F.size("kept")).alias("n_lost"),
    )
    whole = rows.where("not marked").select("row", F.lit(None).cast(lost_some.schema["gone"].dataType).alias("gone"), "row.text", F.lit(0).alias("n_lost"))
    return whole.union(lost_some)


def _cut_chunks(docs: DataFrame) -> DataFrame:
    """(row, gone, text, n_lost): the rows as they are, what they lose, what is left and how many lines go."""
    gone = removals(with_chunks(docs.select("doc_id", "text")))
    keys = gone.withColumnsRenamed({"doc_id": "of", "print": "of_print"})
    rows = docs.select(F.struct("*").alias("row")).withColumn("row_print", F.xxhash64("row.text"))
    joined = rows.join(keys, F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.col("row_print") == F.col("of_print")), "left")
    cut = with_chunks(joined.select(F.struct("row", "gone").alias("doc_id"), F.when(F.col("gone").isNotNull(), F.col("row.text")).alias("text")))
    kept = F.filter("chunks", lambda c, i: ~F.array_contains("gone", i))
    lost = F.aggregate(F.filter("chunks", lambda c, i: F.array_contains("gone", i)), F.lit(0), lambda a, c: a + _breaks(c))
    return cut.select("doc_id.row", "doc_id.gone", "chunks").select(
        "row", "gone",
        F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(kept, plain), "\n")).alias("text"),
        F.when(F.col("gone").isNull(), 0).otherwise(lost).alias("n_lost"),
    )


def _breaks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1


def dedup(docs: DataFrame, runs: bool = True) -> DataFrame:
    """doc_id, text without repeated passages, n_lines and n_removed of every row of ``docs`` (doc_id, text).

    Without ``runs`` only whole chunks go; with it all of ``repeated_runs`` too.
    A null text stays null with no lines; an empty text has one empty line. A text that
    loses every line becomes empty. Rows equal in doc_id and text count as one
    occurrence and share their result.
    """
    return _stripped(docs.select("doc_id", "text"), runs).select(
        "row.doc_id", "text",
        F.coalesce(_breaks(F.col("row.text")), F.lit(0)).cast("bigint").alias("n_lines"),
        F.col("n_lost").cast("bigint").alias("n_removed"),
    )


def strip(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without repeated passages and runs; ``n_chars`` follows the new text.

    A document that loses every word is left out: an earlier one holds all it said.
    """
    left = _stripped(docs, True).where(F.col("gone").isNull() | F.col("text").rlike(WORD))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(F.length("text")).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return left.select(*columns)
