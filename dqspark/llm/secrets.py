"""Secrets in texts: patterns propose candidates, a random forest learnt from labelled findings sifts them."""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from dqspark.llm.common import quoted
from dqspark.session import stored

_CREDENTIAL = "token|secret|passw|pwd|api.?key|auth|credential|bearer|private"
#: Signs that keys are made of: letters, digits, and these. No candidate begins right behind one, so most places fail at once.
_SIGN = "[\\w+/-]"
#: A value that a credential's name is given, of any length from four signs on. The short looks behind fail at once at most
#: places, so the long one is seldom tried.
_ASSIGNED = (
    "(?<=[:=\\s\"'])(?<=[:=]\\s{0,2}[\"']?)"
    f"(?<=(?i:{_CREDENTIAL})[A-Za-z_]{{0,12}}[\"']?\\s{{0,2}}[:=]\\s{{0,2}}[\"']?)"
    "[^\\s\"'<>(){}\\[\\],;]{4,}+"
)
#: Runs of signs that keys are made of, long enough for one, with padding at the end; none starts within another.
_RUN = f"{_SIGN}{{16,}}+={{0,2}}+"
CANDIDATE = f"(?<!{_SIGN})(?:{_ASSIGNED}|{_RUN})"
#: Code points of the text before a candidate, and after it, in which neighbouring words are sought.
BEFORE, AFTER = 40, 20
#: Words of the dictionary at most, and their length; labelled findings that are learnt from at most; trees.
DICTIONARY, LETTERS, SAMPLE, TREES, DEPTH = 1000, (4, 12), 20_000, 24, 6

_WORD = "(?:example|sample|dummy|test|placeholder|redacted)"
_PLACEHOLDER = f"(?<![a-z]){_WORD}(?![a-z])|xxxx"
#: What is no secret: values that such a name or an address precedes, and identifiers of this form.
_PUBLIC = "(?:sha-?[0-9]+|md5|checksum|digest|hash|commit|etag|uuid|guid)[\"']?\\s*[:=]?\\s*[\"']?$|://\\S*$"
_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
FEATURES = (
    "length distinct switches digits upper hexadecimal longest_run dictionary path_depth path_test credential assigned "
    "quoted placeholder"
).split()


def dictionary(docs: DataFrame, text: str = "text", words: int = DICTIONARY) -> list[str]:
    """The commonest words of all texts, which a random key seldom holds; counted before the shuffle."""
    every = F.explode(F.split(F.lower(quoted(text)), "[^a-z]+")).alias("word")
    fit = docs.select(every).filter(F.length("word").between(*LETTERS)).groupBy("word").count()
    return [r["word"] for r in fit.orderBy(F.desc("count"), "word").limit(words).collect()]


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def _placeholder() -> Column:
    """Whether the value says that it is none, or such a word stands directly beside it."""
    beside = F.lower("before").rlike(f"(?<![^\\s\"'(]){_WORD}[\\s\"'(]*$") | F.lower("after").rlike(f"^[\\s\"')]*{_WORD}(?![^\\s\"'),;])")
    return F.lower("value").rlike(_PLACEHOLDER) | beside


def candidates(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """``(id, path, start, end, before, value, after)`` per candidate: a long run of key signs, or any value that a
    credential's name is given.

    Start and end count code points, the end is exclusive. Null texts have none. Each text is cut once at its
    candidates; their places are running sums over the pieces.
    """
    rows = docs.select(
        quoted(id).alias("id"),
        (quoted(path).cast("string") if path else F.lit(None).cast("string")).alias("path"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    # Most texts have no candidate: the filter ends at a text's first, and only texts with one are cut.
    found = rows.filter(F.col("text").rlike(CANDIDATE))
    found = found.withColumn("found", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    found = found.withColumn("gaps", F.split("text", CANDIDATE, -1))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def step(so_far: Column, i: Column) -> Column:
        begin = so_far["at"] + F.length(F.get("gaps", i))
        return F.struct(
            (begin + F.length(F.get("found", i))).alias("at"), F.concat(so_far["starts"], F.array(begin)).alias("starts")
        )

    starts = F.aggregate(F.sequence(F.lit(0), F.size("found") - 1), start, step, lambda s: s["starts"])
    spans = F.arrays_zip(starts.alias("start"), F.col("found").alias("value"))
    return (
        found.withColumn("spans", spans)
        # Each text has a candidate, so the outer form adds no row; for the other Spark would put a filter on the whole of
        # ``spans`` below the scan, and match the pattern anew there for each use of each candidate.
        .withColumn("span", F.explode_outer("spans"))
        .withColumns({"start": F.col("span.start"), "value": F.col("span.value")})
        .withColumn("end", F.col("start") + F.length("value"))
        .withColumn("before", F.expr(f"substring(text, greatest(start - {BEFORE}, 0) + 1, least(start, {BEFORE}))"))
        .withColumn("after", F.expr(f"substring(text, `end` + 1, {AFTER})"))
        .select("id", "path", "start", "end", "before", "value", "after")
    )


def measured(found: DataFrame, words: list[str]) -> DataFrame:
    """Candidates with ``FEATURES``, all numbers; nulls count as empty."""
    value, before = F.col("value"), F.lower("before")
    path = F.coalesce(F.lower("path"), F.lit(""))
    length = F.length(value).cast("double")
    kinds = F.translate(value, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-", "a" * 26 + "A" * 26 + "0" * 10 + "." * 5)
    kinds = F.regexp_replace(kinds, "[^aA0]", ".")
    runs = F.filter(F.split(F.regexp_replace(kinds, "(a+|A+|0+|\\.+)", "$1 "), " "), lambda r: r != "")
    known = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    rest = F.length(F.regexp_replace(F.lower(value), known, "")) if known else length

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    made = {
        "length": length,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / length,
        "switches": (F.size(runs) - 1) / length,
        "digits": F.length(F.regexp_replace(value, "[^0-9]", "")) / length,
        "upper": F.length(F.regexp_replace(value, "[^A-Z]", "")) / length,
        "hexadecimal": flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "longest_run": F.array_max(F.transform(runs, F.length)) / length,
        "dictionary": 1 - rest / length,
        "path_depth": F.size(F.split(path, "[/.]")).cast("double"),
        "path_test": flag(path.rlike("test|example|sample|doc")),
        "credential": flag(before.rlike(_CREDENTIAL)),
        "assigned": flag(before.rlike("[:=]\\s*[\"']?$")),
        "quoted": flag(before.rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "placeholder": flag(_placeholder()),
    }
    return found.withColumns(made)


def train(labelled: DataFrame, sample: int = SAMPLE, seed: int = 2) -> RandomForestClassificationModel | float:
    """A forest from measured findings with ``label`` (1.0 a secret): ``sample`` of them at most, taken by hash.

    With one kind of label only, or none, the result is the smoothed share of secrets instead.
    """
    order = [F.xxhash64("id", "start", "value"), F.col("id"), F.col("start"), F.col("value")]
    chosen = stored(
        labelled.filter("label IS NOT NULL").select("label", *FEATURES, *order[1:]).orderBy(*order).limit(sample), "findings"
    )
    counts = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if len(counts) < 2:
        return (counts.get(1.0, 0) + 1) / (sum(counts.values()) + 2)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird"
    )
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen))


def judged(found: DataFrame, model: RandomForestClassificationModel | float, least: float = 0.5) -> DataFrame:
    """Measured candidates with ``score``, the forest's share for a secret, and ``secret``: whether that is enough."""
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        scored = model.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("secret", F.col("score") >= least)


def seeds(found: DataFrame) -> DataFrame:
    """Findings with a label where none were given: 1 for a mixed value assigned to a credential's name and no
    placeholder; 0 for placeholders, named hashes, parts of addresses, UUIDs, runs without a digit or a letter that
    no such name precedes, and words of letters after such a name without quotes, as in prose; null where neither is certain."""
    before = F.lower("before")
    named = before.rlike(f"(?:{_CREDENTIAL})[a-z_]*[\"']?\\s*[:=]\\s*[\"']?$")
    mixed, public = _mixed(F.col("value")), before.rlike(_PUBLIC) | F.lower("value").rlike(_UUID)
    prose = ~before.rlike("[\"']$") & F.col("value").rlike("^[A-Z]?[a-z]+[.!?:]?$")
    label = F.when(_placeholder() | named & prose, 0.0).when(named & mixed, 1.0).when(~named & (public | ~mixed), 0.0)
    return found.withColumn("label", label)


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
    least: float = 0.5,
) -> DataFrame:
    """``(id, start, end, value, score, secret)``: all candidates of all texts, sifted by the forest.

    ``labelled`` has (id, start, end, label), findings of these documents that someone judged; label is null or not
    0 or 1 for those to be left out. Without it, ``seeds`` gives the labels. Findings whose id has a checksum that is
    a multiple of 5 are held out of training.

    Null and empty texts have no candidates; null ids and paths are kept, a null id is never learnt from;
    repeated rows give repeated findings. No rows, or no labels, give what the prior says of each candidate.
    """
    found = stored(measured(candidates(docs, id, text, path), dictionary(docs, text)), "candidates")
    if labelled is None:
        known = seeds(found)
    else:
        names = ["id", "start", "end"]
        known = found.join(labelled.select(*names, F.col("label").cast("double")).dropDuplicates(names), names)
    learnt = known.filter("label IN (0.0, 1.0) AND crc32(CAST(CAST(id AS STRING) AS BINARY)) % 5 != 0")
    return judged(found, train(learnt), least).select("id", "start", "end", "value", "score", "secret")
