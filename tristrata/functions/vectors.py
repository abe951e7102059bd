"""Vector expressions and text encoders."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import let


def squared_norm(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def l2_normalize(vec: Column) -> Column:
    """Unit-length copy of a vector; the zero vector is returned unchanged."""
    return let(
        F.sqrt(squared_norm(vec)),
        lambda n: F.transform(
            vec, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")).cast("float")
        ),
    )


def is_usable(vec: Column, finite: bool = True) -> Column:
    """Non-null, non-empty and (by default) all-finite vector."""
    ok = vec.isNotNull() & (F.size(vec) > 0)
    if finite:
        ok = ok & F.forall(
            vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
        )
    return F.coalesce(ok, F.lit(False))


class HashedTokens:
    """Feature-hashing encoder: each token adds +1 or -1 to one of ``dim`` slots.

    Runs as a column expression, so no Python worker is started.
    """

    def __init__(self, dim: int = 64):
        if not 1 <= dim <= 65536:
            raise ValueError("dim must be between 1 and 65536")
        self.dim = dim
        self.name = f"hashed-tokens-{dim}"

    def column(self, text: Column) -> Column:
        tokens = F.filter(F.split(F.lower(text), "[ \t\r\n]+"), lambda t: t != "")

        def signed_slot(token: Column) -> Column:
            digest = F.md5(token)
            slot = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % self.dim + 1
            return F.when(F.substring(digest, 5, 1) < "8", slot).otherwise(-slot)

        # Sorted slots form runs; a run's length is the distance to the next run's start,
        # so counting costs one sort and one scan per distinct slot.
        def counts(ordered: Column, slots: Column, starts: Column) -> Column:
            ends = F.concat(F.slice(starts, 2, self.dim * 2), F.array(F.size(ordered).cast("bigint") + 1))
            runs = F.map_from_arrays(slots, F.zip_with(ends, starts, lambda e, b: (e - b).cast("float")))

            def at(m: Column, j: Column) -> Column:
                return F.coalesce(F.try_element_at(m, j), F.lit(0.0).cast("float"))

            return let(
                runs,
                lambda m: F.transform(
                    F.sequence(F.lit(1), F.lit(self.dim)), lambda j: at(m, j) - at(m, -j)
                ),
            )

        zero = F.array_repeat(F.lit(0.0).cast("float"), self.dim)
        return let(
            F.sort_array(F.transform(tokens, signed_slot)),
            lambda s: let(
                F.array_distinct(s),
                lambda u: let(
                    F.transform(u, lambda j: F.array_position(s, j)),
                    lambda starts: F.when(F.size(s) > 0, counts(s, u, starts)).otherwise(zero),
                ),
            ),
        )


#: Bytes of text that are worth a task of their own.
LEAST_BYTES = 64 << 10


def spread(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` dealt out by the measured work of encoding ``text_col``, if it lies unevenly.

    One narrow pass sums the bytes of text in each split. With fewer splits than cores, or
    one that holds more than twice its share, rows are dealt to as many splits as there are
    cores or splits already, whichever is more; texts longer than a share are dealt apart
    from the others. An input that is wide and even is left alone.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint")
    splits = df.select(F.spark_partition_id().alias("split"), size.alias("size")).groupBy("split").agg(
        F.sum("size").alias("size"), F.max("size").alias("longest")
    )
    seen = splits.agg(F.count("*").alias("n"), F.sum("size").alias("all"), F.max("size").alias("most"), F.max("longest").alias("longest")).first()
    wanted = min(max(df.sparkSession.sparkContext.defaultParallelism, seen["n"]), -(-(seen["all"] or 0) // LEAST_BYTES))
    if wanted <= 1:
        return df
    share = seen["all"] / wanted
    if seen["most"] <= 2 * share:
        return df
    if seen["longest"] <= share:
        return df.repartition(wanted)
    return df.where(size <= share).repartition(wanted).union(df.where(size > share).repartition(wanted))


def embed_text(
    df: DataFrame,
    text_col: str,
    out_col: str,
    encoder: HashedTokens | Callable[[], Callable[[Sequence[str]], np.ndarray]] | None = None,
    normalize: bool = True,
    batch_size: int = 1024,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col`` (array<float>) holding the encoding of ``text_col``.

    ``encoder`` is a :class:`HashedTokens` (default) or a factory: it is called once
    per task and returns ``encode(texts) -> 2-D array``, so a model loads once per task;
    only the text goes through Python. Rows are dealt out by measured work first (see
    :func:`spread`), or to so many ``partitions``; 0 leaves them where they are.
    """
    encoder = encoder or HashedTokens()
    if partitions is None:
        df = spread(df, text_col)
    elif partitions:
        df = df.repartition(partitions)
    if isinstance(encoder, HashedTokens):
        encoded = df.withColumn(out_col, encoder.column(F.col(text_col)))
    else:

        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = encoder()
            for texts in batches:
                vectors: list = []
                for start in range(0, len(texts), batch_size):
                    block = texts.iloc[start:start + batch_size].tolist()
                    vectors.extend(np.asarray(model(block), dtype=np.float32))
                yield pd.Series(vectors, dtype=object)

        call = F.pandas_udf(encode, T.ArrayType(T.FloatType()))
        encoded = df.withColumn(out_col, call(F.col(text_col)))
    if normalize:
        encoded = encoded.withColumn(out_col, l2_normalize(F.col(out_col)))
    return encoded


def embed_distinct(
    df: DataFrame,
    text_col: str,
    out_col: str,
    encoder=None,
    normalize: bool = True,
    batch_size: int = 1024,
) -> DataFrame:
    """As :func:`embed_text`, but each distinct text is encoded once and joined back."""
    vectors = embed_text(
        df.select(text_col).distinct(), text_col, out_col, encoder, normalize, batch_size, partitions=0
    )
    return df.drop(out_col).join(vectors, text_col, "left")
