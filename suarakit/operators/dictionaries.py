"""Dictionaries that are tables: ordered keywords searched anywhere in a text, and words replaced.

The functions of :mod:`suarakit.functions` take dictionaries of some dozens of entries, inlined in the
expression. These take any number, and their time does not depend on it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit import constants as K
from suarakit.functions.text import squeeze_space
from suarakit.session import materialise

BROADCAST_BYTES = 32 << 20


def _fresh(names: list[str], wanted: str) -> str:
    while wanted in names:
        wanted += "_"
    return wanted


# --- keywords ---------------------------------------------------------------------------

def first_keyword(
    df: DataFrame,
    text_col: str,
    keywords: DataFrame,
    out: str = "value",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with the value of the keyword of smallest rank that occurs anywhere in the text, else NULL.

    ``keywords`` has ``rank, word, value``; of equal ranks the smaller word wins. One pass of an
    Aho-Corasick automaton finds all keywords of a text at once. Keywords go to the tasks in slices
    of at most ``broadcast_bytes``, usually one, by rank: a later slice looks only at texts in which
    earlier ones found nothing. NULL texts have no keyword; an empty keyword occurs in every other.
    """
    spark = df.sparkSession
    words = keywords.where("word is not null and rank is not null").select("rank", "word", "value")
    words = words.groupBy("word").agg(F.min(F.struct("rank", "value")).alias("first")).select("first.rank", "word", "first.value")
    # Rank, word and value of an entry, and what an automaton takes for it.
    size = words.agg(F.count("*").alias("n"), F.sum(F.octet_length("word") + F.coalesce(F.octet_length("value"), F.lit(0)) + 64)).first()
    slices = max(1, math.ceil((size[1] or 0) / broadcast_bytes))
    words = materialise(words.repartitionByRange(slices, "rank", "word").withColumn("slice", F.spark_partition_id()))
    names = df.columns
    done = df.withColumn(_fresh(names, out) if out in names else out, F.lit(None).cast("string"))
    target = done.columns[-1]
    hit = _fresh(done.columns, "_hit")
    done = done.withColumn(hit, F.lit(False))
    at = names.index(text_col)
    for i in range(slices):
        mine = words.where(F.col("slice") == i).orderBy("rank", "word").select("word", "value").toArrow()
        shared = spark.sparkContext.broadcast((mine["word"].to_pylist(), mine["value"].to_pylist()))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            words, values = shared.value
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            everywhere = len(words)
            for place, word in enumerate(words):
                if word:
                    automaton.add_word(word, place)
                else:
                    everywhere = place
            if len(automaton):
                automaton.make_automaton()
            for batch in batches:
                texts, found, seen = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
                for row, text in enumerate(texts):
                    if text is None or seen[row]:
                        continue
                    best = min((place for _, place in automaton.iter(text)), default=everywhere) if len(automaton) else everywhere
                    best = min(best, everywhere)
                    if best < len(words):
                        found[row], seen[row] = values[best], True
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(found, pa.string()), pa.array(seen, pa.bool_())], names=batch.schema.names)

        done = done.mapInArrow(search, done.schema)
    done = done.drop(hit)
    return done if target == out else done.drop(out).withColumnRenamed(target, out)


# --- words ------------------------------------------------------------------------------

def _core(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(K.SLANG_EDGE_PUNCTUATION)))


def expand_words(
    df: DataFrame, text_col: str, dictionary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``df`` with known words of the text replaced, as :func:`suarakit.functions.text.expand_slang` does.

    ``dictionary`` has ``word`` (lower case) and ``long``; of several entries for a word the
    smallest counts. The distinct words of all texts are joined with it, so only entries that occur
    go on. If they are small enough the tasks get them; otherwise words and entries meet by a join,
    and answers go back to the texts by position.
    """
    spark = df.sparkSession
    entries = dictionary.where("word is not null and long is not null").groupBy("word").agg(F.min("long").alias("long"))
    squeezed = squeeze_space(F.col(text_col))
    occurring = df.select(F.explode(F.split(squeezed, " ")).alias("w")).select(_core(F.col("w")).alias("word")).distinct()
    known = materialise(entries.where("word <> ''").join(occurring, "word", "left_semi"))
    size = known.agg(F.coalesce(F.sum(F.octet_length("word") + F.octet_length("long") + 128), F.lit(0))).first()[0]
    names = df.columns
    if size > broadcast_bytes:
        return _expand_by_join(df, text_col, known)
    mine = known.toArrow()
    shared = spark.sparkContext.broadcast(dict(zip(mine["word"].to_pylist(), mine["long"].to_pylist())))
    at, folded = names.index(text_col), _fresh(names, "_folded")
    # Lower case is Spark's, so both sides agree on every letter; it keeps blanks where they are.
    given = df.withColumn(text_col, squeezed).withColumn(folded, F.lower(F.col(text_col)))
    edge = K.SLANG_EDGE_PUNCTUATION

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out = []
            for text, low in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                if text is None:
                    out.append(None)
                    continue
                words, lows = text.split(" "), low.split(" ")
                for i, word in enumerate(lows):
                    long = known.get(word.strip(edge))
                    if long is not None:
                        core = words[i].strip(edge)
                        words[i] = words[i].replace(core, long)
                out.append(" ".join(words))
            columns = [*batch.columns[:at], pa.array(out, pa.string()), *batch.columns[at + 1 : len(names)]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[: len(names)])

    return given.mapInArrow(run, T.StructType([f if f.name != text_col else T.StructField(text_col, T.StringType()) for f in df.schema.fields]))


def _expand_by_join(df: DataFrame, text_col: str, known: DataFrame) -> DataFrame:
    names = df.columns
    row, words, found = (_fresh(names, n) for n in ("_row", "_words", "_found"))
    rows = materialise(df.withColumn(row, F.monotonically_increasing_id()))
    split = rows.withColumn(words, F.split(squeeze_space(F.col(text_col)), " "))
    places = split.select(row, F.posexplode(words).alias("at", "w")).withColumn("word", _core(F.col("w")))
    answers = places.join(known, "word").groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct("at", "long"))).alias(found))

    def replaced(word: Column, i: Column) -> Column:
        long = F.try_element_at(F.col(found), i)
        return F.when(long.isNull(), word).otherwise(F.replace(word, F.btrim(word, F.lit(K.SLANG_EDGE_PUNCTUATION)), long))

    done = split.join(answers, row, "left")
    text = F.when(F.col(found).isNull(), F.array_join(words, " ")).otherwise(F.array_join(F.transform(words, replaced), " "))
    return done.withColumn(text_col, F.when(F.col(text_col).isNotNull(), text)).select(*names)
