"""A text corpus of one line a record: templates, cleaning, distinct lines, a systematic sample, chunks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.session import cut, stored


def _given(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def decision_line(court: Column, case_number: Column, category: Column, judge: Column, decided: Column) -> Column:
    part = lambda v, before: F.when(_given(v), F.concat(F.lit(before), v, F.lit(".")))
    return F.concat_ws(" ", part(court, "Суд: "), part(case_number, "Справа № "), part(category, "Категорія: "), part(judge, "Суддя: "), part(F.substring(decided, 1, 10), "Рішення від "))


def company_line(form: Column, name: Column, edrpou: Column, state: Column, founders: Column, statute: Column) -> Column:
    """Form (unless the name holds it), name, code, state, up to four founders' names, statute."""
    form, name = F.coalesce(form, F.lit("")), F.coalesce(name, F.lit(""))
    titled = F.when(name != "", F.when((form != "") & F.contains(name, form), name).otherwise(F.trim(F.concat(form, F.lit(" "), name))))
    people = F.filter(F.transform(F.slice(F.coalesce(founders, F.array().cast("array<string>")), 1, 4), lambda f: F.trim(F.substring_index(F.substring_index(f, ";", 1), " - ", 1))), lambda f: f != "")
    part = lambda v, before: F.when(_given(v), F.concat(F.lit(before), v, F.lit(".")))
    return F.concat_ws(" ", titled, part(edrpou, "ЄДРПОУ "), part(state, "Стан: "), F.when(F.size(people) > 0, F.concat(F.lit("Засновники: "), F.array_join(people, ", "), F.lit("."))), part(statute, "Статут: "))


def vat_line(name: Column, code: Column, registered: Column) -> Column:
    since = F.when(_given(registered), registered).otherwise("невідома")
    full = F.concat(name, F.lit(". Платник податку на додану вартість, реєстрація "), since, F.lit(" (ІПН "), code, F.lit(")."))
    return F.when(~_given(name) | name.isNull(), "").when(_given(code), full).otherwise(F.concat(name, F.lit(".")))


def text_line(head: Column, text: Column, least: int = 200, most: int = 2500) -> Column:
    """Head and the text's start, null for texts shorter than ``least``; how much of a text a line takes is the template's rule."""
    body = F.trim(text)
    return F.when(F.length(body) >= least, F.concat_ws(" ", head, F.substring(body, 1, most)))


def distinct_lines(lines: DataFrame, column: str = "line", least: int = 20, most: int = 600) -> DataFrame:
    """(line): cleaned lines of allowed length, each once."""
    return lines.select(T.clean_line(F.col(column), least, most).alias("line")).where("line != ''").distinct()


def numbered(rows: DataFrame, order: str, out: str = "n") -> DataFrame:
    """``rows`` with their 0-based place in the order of a column whose values are distinct, without one task for all.

    Rows are spread by range and sorted there; the counts of the ranges before give each range its offset.
    """
    spread = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    spread = cut(spread)  # so that a lost executor can't change which rows a part holds
    sizes = spread.groupBy("__part").agg(F.count("*").alias("c"), F.min("__at").alias("__first")).orderBy("__part").collect()  # one row a partition
    offset, rows_ = 0, []
    for r in sizes:
        rows_.append((r["__part"], offset, r["__first"]))
        offset += r["c"]
    starts = rows.sparkSession.createDataFrame(rows_ or [(-1, 0, 0)], "__part int, __offset long, __first long")
    return spread.join(F.broadcast(starts), "__part").withColumn(out, F.col("__offset") + F.col("__at") - F.col("__first")).drop("__part", "__at", "__offset", "__first")


def systematic_sample(lines: DataFrame, column: str = "line", target: int = 1_600_000) -> DataFrame:
    """Every k-th line of the sorted distinct lines, k the whole number that brings about ``target`` lines."""
    lines = stored(lines.select(column), n=F.count("*"))  # counted, ranged and sorted: read three times, made once
    stride = max(1, lines.seen["n"] // target)
    return numbered(lines, column).where(F.col("n") % stride == 0).select(column)


def first_rows(rows: DataFrame, order: str, most: int) -> DataFrame:
    """The first ``most`` rows in the order of a column, as the limit of a source asks; a partition keeps ``most`` at most."""
    return rows.orderBy(order).limit(most)


def build(sources: Mapping[str, tuple[DataFrame, int | None]], target: int = 1_600_000, least: int = 20, most: int = 600) -> tuple[DataFrame, DataFrame]:
    """The corpus and its counts: (line), and (source, written, lines).

    ``sources`` gives by name rows (seq, line) and how many lines of it count, None for all. Empty lines do not count, lines that
    are dropped for their length do. Lines are cleaned, each taken once over all sources, and sampled systematically;
    the counts have each source's lines and, under '', all distinct ones and those sampled.
    """
    parts, counted = [], []
    for name, (rows, limit) in sources.items():
        given = rows.where("line is not null and line != ''")
        given = given if limit is None else first_rows(given, "seq", limit)
        parts.append(given.select(F.lit(name).alias("source"), T.clean_line(F.col("line"), least, most).alias("line")))
    lines = stored(reduce(DataFrame.unionByName, parts))
    distinct = stored(lines.where("line != ''").select("line").distinct(), n=F.count("*"))
    corpus = stored(systematic_sample(distinct, target=target), n=F.count("*"))
    counted = lines.groupBy("source").agg(F.count("*").alias("written"), F.count_if(F.col("line") != "").alias("lines"))
    return corpus, counted.unionByName(lines.sparkSession.createDataFrame([("", distinct.seen["n"], corpus.seen["n"])], "source string, written long, lines long"))


def split_validation(chunks_: DataFrame, order: str, least: int = 64, part: int = 50) -> tuple[DataFrame, DataFrame]:
    """(validation, training): the first max(``least``, n // ``part``) chunks in the order of a column of distinct values, and the rest."""
    rows = stored(chunks_, n=F.count("*"))
    most = max(least, rows.seen["n"] // part)
    ranked = numbered(rows, order)
    return ranked.where(F.col("n") < most).drop("n"), ranked.where(F.col("n") >= most).drop("n")


def shuffled(rows: DataFrame, column: str, seed: int) -> DataFrame:
    """Rows with a key ``shuffled`` to order them by: the same for the same seed, whatever the partitions."""
    return rows.withColumn("shuffled", F.xxhash64(F.lit(seed), F.col(column)))


def word_counts(lines: DataFrame, column: str = "line", least: int = 1) -> DataFrame:
    """(word, n): how often each word between blanks occurs, at least ``least`` times."""
    words = lines.select(F.explode(F.split(F.trim(F.col(column)), r"(?U)\s+")).alias("word")).where("word != ''")
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def sampled_mean(metrics: DataFrame, value: str, by: Sequence[str], draws: int = 16, seed: int = 17) -> DataFrame:
    """(*by, mean, n): the mean of ``draws`` values drawn per group by a seeded hash of their ordinal; the draw is the operator.

    Groups keep the values of their least hashes in one mergeable aggregate each.
    """
    drawn = Window.partitionBy(*by).orderBy(F.xxhash64(F.lit(seed), F.col("ordinal")), "ordinal")
    rows = metrics.where(F.col(value).isNotNull()).withColumn("__k", F.row_number().over(drawn)).where(F.col("__k") <= draws)
    return rows.groupBy(*by).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))


def _outcome(sizes: list[int], room: int) -> tuple[list[int], list[int]]:
    """For every size 0..room that a chunk has when a run of lines begins: its size at the end, and the chunks ended meanwhile."""
    cum = np.cumsum(np.array(sizes, np.int64))
    before = np.concatenate(([0], cum))
    ends = np.searchsorted(cum, before[:-1] + room, side="right")  # the line that ends a chunk begun with line k
    n = len(sizes)
    size, ended = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for k in range(n - 1, -1, -1):
        size[k], ended[k] = (size[ends[k] + 1], ended[ends[k] + 1] + 1) if ends[k] < n else (cum[-1] - before[k], 0)
    held = np.arange(room + 1)
    first = np.searchsorted(cum, room - held, side="right")
    open_ = first >= n
    after = np.where(open_, 0, np.minimum(first + 1, n))
    return np.where(open_, held + cum[-1], size[after]).tolist(), np.where(open_, 0, ended[after] + 1).tolist()


def chunks(lines: DataFrame, group: str, order: str, line: str = "line", room: int = 1200) -> DataFrame:
    """(group, chunk, text): a group's lines joined in order, a chunk ends with the line that takes it over ``room``.

    The unfinished tail of a group is dropped, as the operator defines; null lines do not count, lines of equal order come in
    their own. A group is folded by as many tasks as it has ranges of rows: each range is first summed up as what it makes of
    any size a chunk may have where it begins (0 to ``room``), these sums are composed along the group, and then every range is
    folded from the size it really begins with. Only chunks that lie across ranges are put together afterwards.
    """
    kind = lines.schema[group].dataType.simpleString()
    rows = lines.where(F.col(line).isNotNull()).select(F.col(group).alias("g"), F.col(order).alias("o"), F.col(line).alias("line"))
    rows = cut(rows.repartitionByRange("g", "o").sortWithinPartitions("g", "o", "line").select("g", "line", F.spark_partition_id().alias("part")))

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, int, pd.Series]]:
        for batch in batches:
            keys = batch["g"].where(batch["g"].notna(), None)
            starts = (keys.ne(keys.shift()) & ~(keys.isna() & keys.shift().isna())).cumsum()
            for _, some in batch.groupby(starts, sort=False):
                yield (None if pd.isna(some["g"].iloc[0]) else some["g"].iloc[0]), int(some["part"].iloc[0]), some["line"]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple[object, int, list[int]]] = []
        for g, part, texts in runs(batches):
            if not found or found[-1][0] != g:
                if len(found) > 1:
                    del found[1:]  # only a range's first and last group go on in others
                found.append((g, part, []))
            found[-1][2].extend((texts.str.len() + 1).tolist())
        yield pd.DataFrame([(g, part, *_outcome(sizes, room)) for g, part, sizes in found], columns=["g", "part", "size", "ended"])

    def along(keys: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        out, held, ended = [], 0, 0
        for part, size, more in blocks.sort_values("part")[["part", "size", "ended"]].itertuples(index=False):
            out.append((keys[0], part, held, ended))
            held, ended = size[held], ended + more[held]
        return pd.DataFrame(out, columns=["g", "part", "held", "ended"])

    summed = rows.mapInPandas(sums, f"g {kind}, part int, size array<long>, ended array<long>")
    begins = stored(summed.groupBy("g").applyInPandas(along, f"g {kind}, part int, held long, ended long").where("held > 0 or ended > 0"))
    # at most one a range: the group it goes on with
    joined = rows.join(F.broadcast(begins.select("part", F.col("g").alias("__g"), "held", "ended")), "part", "left")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: tuple | None = None
        pieces, size, chunk, part, begun = [], 0, 0, 0, True
        for batch in batches:
            out = []
            for g, p, texts in runs([batch]):
                if at != (g,):
                    if pieces:
                        out.append((at[0], chunk, part, "\n".join(pieces), begun, False))
                    first = batch.loc[texts.index[0]]
                    goes_on = pd.notna(first["held"]) and (first["__g"] == g or (g is None and pd.isna(first["__g"])))
                    at, pieces, part = (g,), [], p
                    size, chunk = (int(first["held"]), int(first["ended"])) if goes_on else (0, 0)
                    begun = size == 0
                for text in texts:
                    pieces.append(text)
                    size += len(text) + 1
                    if size > room:
                        out.append((g, chunk, p, "\n".join(pieces), begun, True))
                        pieces, size, chunk, begun = [], 0, chunk + 1, True
            yield pd.DataFrame(out, columns=["g", "chunk", "part", "text", "begun", "ended"])
        if pieces:
            yield pd.DataFrame([(at[0], chunk, part, "\n".join(pieces), begun, False)], columns=["g", "chunk", "part", "text", "begun", "ended"])

    made = stored(joined.mapInPandas(fold, f"g {kind}, chunk int, part int, text string, begun boolean, ended boolean"))
    whole = made.where("begun and ended").select("g", "chunk", "text")
    across = made.where("not (begun and ended)").groupBy("g", "chunk").agg(F.sort_array(F.collect_list(F.struct("part", "text"))).alias("p"), F.bool_or("ended").alias("done")).where("done")
    return whole.unionByName(across.select("g", "chunk", F.array_join("p.text", "\n").alias("text"))).withColumnRenamed("g", group)


def encode(lines: DataFrame, tokenizer: str, column: str = "line", separator: int = 0) -> DataFrame:
    """(line, ids): token numbers of a public tokenizers-library file, a separator at the end."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(tokenizer)
        coder.encode_special_tokens = True
        for batch in batches:
            got = coder.encode_batch(batch.fillna("").tolist(), add_special_tokens=False)
            yield pd.Series([[*x.ids, separator] for x in got])

    ids = F.pandas_udf(run, "array<int>")
    return lines.select(column, ids(F.col(column)).alias("ids"))
