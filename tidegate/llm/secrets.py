"""Secret scans: candidates by pattern, false positives removed by a random forest.

DataFrame and SQL expressions throughout; the forest is Spark ML's. Candidates are all
parts of a text's words that look like a token with digits, a known key format or the value of an
assignment, and what stands behind a credential's name. The forest
judges each by its length, how its characters follow each other, how much of it words of a dictionary
cover, the path it was found under and the words beside it. Dictionary and transitions are learnt from
all the texts; the forest is trained from labelled findings of known making. Whether a
candidate has an issuer's format is one feature among the others; it has no part in the labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.llm.repeated_windows import keyed, tagged
from tidegate.llm.scratch import shipped, written
from tidegate.llm.secret_findings import labelled_texts

SPACE = "[\\x20\\x09-\\x0D]+"
#: Bound of the training sample, in findings of each label.
SAMPLE_ROWS = 5000
TREES, DEPTH, SEED = 30, 8, 17
THRESHOLD = 0.5

#: Formats of issuers, in the order in which they are tried.
FORMATS = (
    ("aws_key_id", "A(?:KIA|SIA)[0-9A-Z]{16}"),
    ("github_token", "gh[pousr]_[0-9A-Za-z]{36,}"),
    ("slack_token", "xox[abprs]-[0-9A-Za-z-]{10,}"),
    ("google_key", "AIza[0-9A-Za-z_-]{35}"),
    ("stripe_key", "[rs]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    ("jwt", "eyJ[0-9A-Za-z_-]{8,}\\.eyJ[0-9A-Za-z_-]{8,}\\.[0-9A-Za-z_-]*"),
    ("npm_token", "npm_[0-9A-Za-z]{36}"),
    ("api_key", "sk-[0-9A-Za-z_-]{20,}"),
)
NAMES = "(?:password|passwd|passphrase|pwd|secret|token|api_?key|access_?key|auth|credentials?|private_?key)"
SHAPE = "|".join(p for _, p in FORMATS)
#: The value of an assignment; it ends where the next parameter of a query string begins.
VALUE = "(?!" + SHAPE + ")(?=[^\"'\\s,;&][^\"'\\s,;]{5})([^\"'\\s,;&]++(?:&(?![0-9A-Za-z_.-]+=)[^\"'\\s,;&]*+)*+)"
ASSIGNED = f"(?<![0-9A-Za-z_.-])[0-9A-Za-z_.-]*(?i:{NAMES})[\"']?[=:]+[\"']?{VALUE}"
#: The value at the head of a word that stands behind a credential's name.
HEADED = f"^[\"'(\\[{{<=:]*+{VALUE}"
NAMED = f"(?i){NAMES}[\"']?\\s*[=:]*$"
BARE = "([0-9A-Za-z+/_=-]{12,})"
#: What makes a text worth cutting into words.
GATE = "[0-9]|(?i:" + NAMES + ")"
#: Bare characters with a digit among them, wherever they stand in a word.
MIXED = "(?<![0-9A-Za-z+/_=-])(?=[A-Za-z+/_=-]*[0-9])" + BARE
#: Words of the dictionary, the most frequent of all texts.
DICTIONARY_WORDS = 2000
#: Kinds of characters between which changes are counted.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-_"
FEATURES = [
    "length", "distinct", "digits", "uppers", "others", "case_changes", "digit_changes", "digit_runs", "longest_letters", "vowels",
    "hex_only", "issued", "transition", "known", "path_known", "path_dirs", "assigned", "beside_name", "beside_sum", "beside_doubt", "at_sign", "slashes", "dots",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """(id, tag, doc_id, word, at, rule, secret, token, before, after, path) of each candidate; word counts the text's words from 0, at the word's characters.

    A word has as many candidates as it has matches; token is the part of it around this one.
    """
    path = F.col(path_col).cast("string") if path_col and path_col in docs.columns else F.lit(None).cast("string")
    keys = keyed(docs.withColumn("_path", path), id_col, text_col, "_path").where(F.col("text").rlike(GATE))
    words = keys.select("id", "tag", "doc_id", "_path", F.array_remove(F.split("text", SPACE), "").alias("words"), F.col("text").rlike(f"(?i){NAMES}").alias("names"))
    worth = f"{SHAPE}|{ASSIGNED}|^[\"'(\\[{{<,]*(?=[^\\s]*[0-9]){BARE}|{MIXED}|@[^@\\s]*\\.|://|[0-9]\\.[0-9]|[0-9]-[0-9]"

    def stands_out(at: Column) -> Column:
        word, beside = F.get(F.col("words"), at), F.concat_ws(" ", F.get(F.col("words"), at - 2), F.get(F.col("words"), at - 1))
        return word.rlike(worth) | (F.col("names") & (F.length(word) >= 6) & beside.rlike(NAMED) & word.rlike(HEADED))

    spots = F.filter(F.sequence(F.lit(0), F.size("words") - 1), stands_out)
    found = words.where(F.size("words") > 0).select("id", "tag", "doc_id", "_path", "words", F.explode(spots).alias("word"))
    here = found.select(
        "id", "tag", "doc_id", "_path", "word", F.get("words", F.col("word")).alias("whole"),
        F.array_join(F.slice("words", F.greatest(F.col("word") - 1, F.lit(1)), F.least(F.col("word"), F.lit(2))), " ").alias("before"),
        F.array_join(F.slice("words", F.col("word") + 2, F.lit(2)), " ").alias("after"),
    )
    named = F.col("before").rlike(NAMED)
    cut = here.withColumn("pieces", F.when(named, _pieces("whole", f"{SHAPE}|{HEADED}|{ASSIGNED}")).otherwise(_pieces("whole", f"{SHAPE}|{ASSIGNED}")))
    cut = cut.withColumn("pieces", F.when(F.exists("pieces", lambda p: p["kind"] > 0), F.col("pieces")).otherwise(F.array(F.struct(F.col("whole").alias("text"), F.lit(3).alias("kind")))))
    places = F.filter(F.sequence(F.lit(0), F.size("pieces") - 1), lambda at: F.get(F.col("pieces"), at)["kind"] > 0)
    each = cut.withColumn("place", F.explode(places)).withColumn("piece", F.get("pieces", F.col("place")))
    last = F.col("place") + 2 == F.size("pieces")
    sides = [F.get("pieces", F.col("place") - 1), F.get("pieces", F.col("place") + 1)]
    near = [F.when((p["kind"] == 0) & here_too, p["text"]).otherwise("") for p, here_too in zip(sides, (F.lit(True), last))]
    text, kind = F.col("piece.text"), F.col("piece.kind")
    rule, secret = F.when(kind == 1, "long_token").when(kind == 3, "other").otherwise("assignment"), text
    value = F.regexp_extract(text, ASSIGNED, 1)
    secret = F.when(kind != 2, text).when(value != "", value).otherwise(F.regexp_extract(text, HEADED, 1))
    for name, p in reversed(FORMATS):
        is_format = (kind == 2) & text.rlike(f"^(?:{p})$")
        rule, secret = F.when(is_format, name).otherwise(rule), F.when(is_format, text).otherwise(secret)
    ahead = F.aggregate(F.slice("pieces", F.lit(1), F.col("place")), F.lit(0), lambda n, p: n + F.length(p["text"]))
    out = each.select(
        "id", "tag", "doc_id", "word", ahead.alias("at"), rule.alias("rule"), secret.alias("secret"), F.concat(near[0], text, near[1]).alias("token"),
        "before", "after", text.alias("_match"), F.coalesce("_path", F.lit("")).alias("path"),
    )
    at = (F.col("at") + F.length("_match") - F.length("secret")).cast("int")
    return out.where("length(secret) >= 6 or rule = 'other'").withColumn("at", at).drop("_match")


def _pieces(token: str, pattern: str) -> Column:
    """The token cut up, in order: text, and kind, 2 for each match of `pattern`, 1 for each `BARE` one between these, 0 for the rest."""

    def cut(text: Column, by: str, kind: int, rest) -> Column:
        hits = F.regexp_extract_all(text, F.lit(by), F.lit(0))
        here = lambda part, at: F.concat(rest(part), F.array(F.struct(F.get(hits, at).alias("text"), F.lit(kind).alias("kind"))))
        return F.flatten(F.transform(F.split(text, by, -1), here))

    plain = lambda text: F.array(F.struct(text.alias("text"), F.lit(0).alias("kind")))
    return F.filter(cut(F.col(token), pattern, 2, lambda part: cut(part, BARE, 1, plain)), lambda p: p["text"] != "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


@dataclass(frozen=True)
class Prose:
    """What ordinary words of a corpus look like: its frequent words, and how likely each character follows another."""

    words: tuple[str, ...]
    follows: tuple[float, ...]


def learn_prose(docs: DataFrame, text_col: str = "text") -> Prose:
    """From the words of all texts: two aggregates, of bounded results."""
    text = F.lower(F.col(text_col).cast("string"))
    words = docs.select(F.explode(F.regexp_extract_all(text, F.lit("[a-z]{3,24}"), F.lit(0))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    words = written(words.orderBy(F.desc("n"), "w").limit(DICTIONARY_WORDS))
    places = F.sequence(F.lit(1), F.length("w") - 1)
    pairs = words.select("n", F.explode(F.transform(places, lambda at: F.substring(F.col("w"), at, F.lit(2)))).alias("pair"))
    met = {r.pair: r.n for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    size = len(ALPHABET)
    rows = [[met.get(a + b, 0) + 0.5 for b in ALPHABET] for a in ALPHABET]
    follows = [math.log(n * size / sum(row)) for row in rows for n in row]
    return Prose(tuple(sorted(r.w for r in words.collect())), tuple(round(x, 6) for x in follows))


def _transition(text: Column, prose: Prose) -> Column:
    """Mean log-likelihood of each character after the one before, against chance, in lower case."""
    kind = lambda at: F.instr(F.lit(ALPHABET), F.substring(text, at, F.lit(1)))
    table = F.array(*map(F.lit, prose.follows))
    places = F.when(F.length(text) >= 2, F.sequence(F.lit(1), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    each = F.filter(F.transform(places, lambda at: F.struct(kind(at).alias("a"), kind(at + 1).alias("b"))), lambda p: (p["a"] > 0) & (p["b"] > 0))
    total = F.aggregate(each, F.lit(0.0), lambda s, p: s + F.get(table, (p["a"] - 1) * len(ALPHABET) + p["b"] - 1))
    return total / F.greatest(F.size(each), F.lit(1))


def _dictionary(text: Column, prose: Prose) -> Column:
    """Characters of the text that are words of the dictionary, cut at changes of case and at what is no letter."""
    parts = F.regexp_extract_all(text, F.lit("[A-Z]?[a-z]{2,}|[A-Z]{3,}"), F.lit(0))
    known = F.filter(parts, lambda w: F.lower(w).isin(*prose.words) if prose.words else F.lit(False))
    return F.aggregate(known, F.lit(0), lambda n, w: n + F.length(w))


def with_features(found: DataFrame, prose: Prose) -> DataFrame:
    secret, lower = F.col("secret"), F.lower("secret")
    size = F.greatest(F.length(secret), F.lit(1)).cast("double")
    runs = F.transform(F.split(secret, "[^A-Za-z]+"), lambda w: F.length(w))
    beside = F.lower(F.concat_ws(" ", "before", "after"))
    features = {
        "length": size,
        "distinct": F.size(F.array_distinct(F.split(secret, ""))) / size,
        "digits": _count(secret, "[0-9]") / size,
        "uppers": _count(secret, "[A-Z]") / size,
        "others": _count(secret, "[^0-9A-Za-z]") / size,
        "case_changes": (_count(secret, "[a-z](?=[A-Z])") + _count(secret, "[A-Z](?=[a-z])")) / size,
        "digit_changes": (_count(secret, "[0-9](?=[A-Za-z])") + _count(secret, "[A-Za-z](?=[0-9])")) / size,
        "digit_runs": _count(secret, "[0-9]+"),
        "longest_letters": F.array_max(runs) / size,
        "vowels": _count(lower, "[aeiou]") / F.greatest(_count(lower, "[a-z]"), F.lit(1)),
        "hex_only": secret.rlike("^[0-9a-fA-F]+$").cast("double"),
        "issued": F.col("rule").isin(*(name for name, _ in FORMATS)).cast("double"),
        "transition": _transition(lower, prose),
        "known": _dictionary(secret, prose) / size,
        "path_known": F.col("path").rlike("(?i)test|example|sample|doc|spec|fixture|mock").cast("double"),
        "path_dirs": _count(F.col("path"), "/"),
        "assigned": (F.col("before").rlike("[=:]$") | F.col("token").rlike("[=:][\"']?[^\"'=:]*[\"']?$")).cast("double"),
        "beside_name": (F.col("before").rlike(NAMED) | F.col("token").rlike("(?i)" + NAMES + "[\"']?[=:]")).cast("double"),
        "beside_sum": beside.rlike("sha|md5|hash|checksum|commit|order|build|version").cast("double"),
        "beside_doubt": F.concat_ws(" ", beside, lower).rlike("example|sample|dummy|placeholder|your|changeme|redacted|xxxx").cast("double"),
        "at_sign": F.col("token").contains("@").cast("double"),
        "slashes": _count(F.col("token"), "/"),
        "dots": _count(F.col("token"), "\\."),
    }
    return found.select("*", *(F.coalesce(value.cast("double"), F.lit(0.0)).alias(name) for name, value in features.items()))


def labelled_findings(spark: SparkSession, prose: Prose) -> DataFrame:
    """Candidates in texts of known making, with features, `label` and `draw`.

    A candidate that holds the value of its text, or is part of it, has the text's label; any other is
    left out.
    """
    rows = labelled_texts()
    schema = "doc_id long, text string, source string, value string, label int, draw int"
    texts = spark.createDataFrame(rows, schema)
    made = texts.select("doc_id", "value", "label", "draw")
    found = candidates(texts, path_col="source").join(F.broadcast(made), "doc_id")
    own = F.contains("secret", F.col("value")) | F.contains("value", F.col("secret"))
    return with_features(found.where(own), prose)


def fit_forest(labelled: DataFrame) -> PipelineModel | None:
    """A forest from findings with features and `label` (0 or 1), at most `SAMPLE_ROWS` of each, by a hash of what was found. None unless both labels occur."""
    key = F.xxhash64("secret", "before", "after")
    sample = None
    for label in (0, 1):
        rows = labelled.where(F.col("label") == label).select("label", "secret", "before", "after", *FEATURES).distinct()
        rows = rows.orderBy(key, "secret", "before", "after").limit(SAMPLE_ROWS)
        sample = rows if sample is None else sample.union(rows)
    sample = written(sample.coalesce(1).orderBy("label", key))
    if sample.select("label").distinct().count() < 2:
        return None
    into = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features", maxMemoryInMB=64)
    return PipelineModel([into, forest.fit(into.transform(sample.withColumn("label", F.col("label").cast("double"))))])


def judge(found: DataFrame, forest: PipelineModel) -> DataFrame:
    """Adds score, the share of the forest that takes a finding for a secret, and kept."""
    out = forest.transform(found).withColumn("score", vector_to_array("probability").getItem(1)).drop("features", "rawPrediction", "probability", "prediction")
    return out.withColumn("kept", F.col("score") >= THRESHOLD)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", labelled: DataFrame | None = None
) -> DataFrame:
    """One row per candidate: id, tag, doc_id, word, at, rule, secret, features, score and kept.

    The forest is trained from the labelled findings of `secret_findings`, the look of ordinary words
    from the texts themselves; ids and labels of documents play no part. `labelled` takes other
    findings of that form. A null or empty text has no candidates. Repeated rows have rows of their
    own. An empty table gives an empty table.
    """
    prose = learn_prose(docs, text_col)
    forest = fit_forest(labelled_findings(docs.sparkSession, prose) if labelled is None else labelled)
    if forest is None:
        raise ValueError("labelled findings must have both labels")
    return judge(written(with_features(candidates(docs, id_col, text_col, path_col), prose)), forest)


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """`docs` with each kept secret replaced by `mark` where it was found, and nowhere else; other texts and all other columns stay as they are.

    Findings that overlap give one mark.
    """
    marked, (id_, tag) = tagged(docs, id_col, text_col)
    cuts = f"{tag}_cuts"
    spots = found.where("kept").groupBy("id", "tag", "word").agg(F.sort_array(F.collect_set(F.struct("at", F.length("secret").alias("size")))).alias("spots"))
    gone = spots.groupBy(F.col("id").alias(id_), F.col("tag").alias(tag)).agg(F.sort_array(F.collect_list(F.struct("word", "spots"))).alias(cuts))
    out = marked.join(gone, [id_, tag], "left")
    clean = F.expr(_redacted(f"`{text_col}`", f"`{cuts}`", mark))
    return out.select(*(F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(clean).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def _redacted(text: str, cuts: str, mark: str) -> str:
    """SQL of `text` with the places of `cuts`, (word, [(at, size)]) in order, replaced by `mark`.

    Words and the space between them are pieces in turn; word k is piece 2k, or 2k + 1 behind leading space.
    """
    piece = r"\\x20\\x09-\\x0D"
    said = mark.replace("\\", "\\\\").replace("'", "\\'")
    word = f"""aggregate(c.spots, struct('' as done, 0 as upto),
      (s, p) -> if(p.at < s.upto, struct(s.done as done, greatest(s.upto, p.at + p.size) as upto),
        struct(concat(s.done, substring(w, s.upto + 1, p.at - s.upto), '{said}') as done, p.at + p.size as upto)),
      s -> concat(s.done, substring(w, s.upto + 1)))"""
    pieces = f"regexp_extract_all({text}, '[{piece}]+|[^{piece}]+', 0)"
    lead = f"if({text} rlike '^[{piece}]', 1, 0)"
    return f"""aggregate({cuts}, struct(cast(array() as array<string>) as parts, 0 as next, {pieces} as pieces),
      (a, c) -> struct(concat(a.parts, slice(a.pieces, a.next + 1, 2 * c.word + {lead} - a.next),
          transform(slice(a.pieces, 2 * c.word + {lead} + 1, 1), w -> {word})) as parts, 2 * c.word + {lead} + 1 as next, a.pieces as pieces),
      a -> array_join(concat(a.parts, slice(a.pieces, a.next + 1, size(a.pieces))), ''))"""


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(shipped(spark).read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", F.col("word").cast("long").alias("word"), "rule", F.length("secret").cast("long").alias("length"),
        F.sha2(F.col("secret").cast("binary"), 256).alias("secret_sha256"), "score", "kept",
    )
