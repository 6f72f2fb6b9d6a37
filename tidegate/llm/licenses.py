"""License scans by ordered signature rules, in DataFrame expressions only.

Keywords are looked for first: a text without any is done after one regular expression. Around each
keyword a window of words is cut, equal windows are scanned once (a notice that stands in a third of
all texts is one row), and only the rules of that keyword run on it. Detections of a text are then
resolved by rank: one that lies within a detection of its own or a higher rank is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidegate.llm.license_rules import Rule, rules
from tidegate.llm.repeated_windows import keyed
from tidegate.llm.scratch import shipped

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORDS_BEFORE, WINDOW_WORDS = 14, 36
RANKS = (1, 2, 3)
#: Fixed phrases and their labels, counted in every text.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(lower: Column) -> Column:
    return F.array_remove(F.split(lower, NOT_WORD), "")


def _phrase_at(words: Column, at: Column, phrase: str) -> Column:
    found = F.lit(True)
    for k, word in enumerate(phrase.split()):
        found = found & (F.get(words, at + k) == word)
    return found


def base_places(words: Column) -> Column:
    """(start, label) of each place where a base phrase stands."""
    places = F.sequence(F.lit(0), F.size(words) - 1)

    def label(at: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, name in BASE:
            out = F.when(_phrase_at(words, at, phrase), name).otherwise(out)
        return out

    marked = F.transform(places, lambda at: F.struct(at.alias("start"), label(at).alias("label")))
    return F.filter(marked, lambda m: m["label"].isNotNull())


def rule_table(spark: SparkSession, chosen: list[Rule]) -> DataFrame:
    """The rules as a literal table; a few hundred rows, whatever the input."""
    rows = [(r.name, r.label, r.keyword, f"(?:^| )({r.pattern})(?= |$)", r.rank, r.weight) for r in chosen]
    return spark.createDataFrame(rows, "rule string, label string, keyword string, pattern string, rank int, weight double")


def keyword_windows(keys: DataFrame, keywords: list[str]) -> DataFrame:
    """(id, tag, base, keyword, window): words around each keyword; base is the window's first word."""
    lower = keys.select("id", "tag", lowered(F.col("text")).alias("lower")).where(F.col("lower").rlike("|".join(sorted(keywords))))
    words = lower.select("id", "tag", words_of(F.col("lower")).alias("words"))
    spots = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda at: F.get(F.col("words"), at).isin(*keywords))
    found = words.where(F.size("words") > 0).select("id", "tag", "words", F.explode(spots).alias("at"))
    base = F.greatest(F.col("at") - WORDS_BEFORE, F.lit(0))
    return found.select(
        "id", "tag", base.alias("base"), F.get("words", F.col("at")).alias("keyword"),
        F.array_join(F.slice("words", base + 1, F.lit(WINDOW_WORDS)), " ").alias("window"),
    )


def detections(keys: DataFrame, chosen: list[Rule]) -> DataFrame:
    """(id, tag, start, stop, rule, label, rank, weight): what rules find, in words, before any is suppressed."""
    table = F.broadcast(rule_table(keys.sparkSession, chosen))
    spots = keyword_windows(keys, sorted({r.keyword for r in chosen}))
    distinct = spots.select("keyword", "window").distinct()
    met = (
        distinct.join(table, "keyword")
        .withColumn("hits", F.expr("regexp_extract_all(window, pattern, 0)"))
        .where("size(hits) > 0")
        .withColumn("parts", F.expr("split(window, pattern, -1)"))
        .select("*", F.posexplode("hits").alias("k", "hit"))
        .withColumn("ahead", F.expr("concat(array_join(slice(parts, 1, k + 1), ''), array_join(slice(hits, 1, k), ''))"))
        .withColumn("before", F.expr("substring(window, 1, length(ahead))"))
        .withColumn("offset", F.expr("if(startswith(hit, ' '), size(split(before, ' ')), 0)"))
        .withColumn("length", F.expr("size(split(trim(hit), ' '))"))
        .select("keyword", "window", "rule", "label", "rank", "weight", "offset", "length")
    )
    start = F.col("base") + F.col("offset")
    return (
        spots.join(met, ["keyword", "window"])
        .select("id", "tag", start.alias("start"), (start + F.col("length")).alias("stop"), "rule", "label", "rank", "weight")
        .distinct()
    )


def unsuppressed(found: DataFrame) -> DataFrame:
    """Detections that no detection of their own or a higher rank contains; of equal ones the first rule stays."""
    earlier = Window.partitionBy("id", "tag").orderBy("start", F.desc("stop"), F.desc("rank"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = found
    for rank in RANKS:
        reach = reach.withColumn(f"reach_{rank}", F.max(F.when(F.col("rank") >= rank, F.col("stop"))).over(earlier))
    own = F.coalesce(*(F.when(F.col("rank") == rank, F.coalesce(f"reach_{rank}", F.lit(-1))) for rank in RANKS))
    return reach.where(own < F.col("stop")).drop(*(f"reach_{rank}" for rank in RANKS))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chosen: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found) of each row of `docs`.

    found lists the detections left, as (start, stop, rule, label). score is the largest weight of
    these, 0.9 where only a base phrase stands, else 0. A null text is empty. Repeated rows get the
    same answer; texts that differ under one id are told apart. Extra columns are ignored.
    """
    chosen = rules() if chosen is None else chosen
    keys = keyed(docs, id_col, text_col)
    lower = keys.select("id", "tag", "doc_id", lowered(F.col("text")).alias("lower"))
    words = lower.select("id", "tag", "doc_id", F.contains("lower", F.lit("license")).alias("gate"), words_of(F.col("lower")).alias("words"))
    none = F.array().cast("array<struct<start:int,label:string>>")
    based = words.select(
        "id", "tag", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.when(F.col("gate") & (F.size("words") > 0), base_places(F.col("words"))).otherwise(none).alias("places"),
    )
    kept = unsuppressed(detections(keys, chosen)).groupBy("id", "tag").agg(
        F.sort_array(F.collect_set("label")).alias("more"),
        F.max("weight").alias("weight"),
        F.sort_array(F.collect_list(F.struct("start", "stop", "rule", "label"))).alias("found"),
    )
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.coalesce("more", F.array().cast("array<string>"))
    return based.join(kept, ["id", "tag"], "left").select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(F.coalesce("weight", F.lit(0.0)), F.when(F.size("places") > 0, 0.9).otherwise(0.0)).alias("score"),
        F.coalesce("found", F.array().cast("array<struct<start:int,stop:int,rule:string,label:string>>")).alias("found"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")).drop("found")
