"""Secrets in text: candidates by pattern, false positives removed by a random forest.

Everything on the way is a DataFrame expression or Spark's own classifier.  A candidate is a run
of at least 16 letters, digits and ``+/_-`` with a digit in it, ``=`` only as its end, or any
value of at least 6 characters that a secret's name with ``=`` or ``:`` precedes.  The forest
looks at its length, its changes between kinds of characters, how much of it common words cover,
the path around it and the path of its document, and the words next to it.

Labelled findings may be given; otherwise they are derived: a value with letters and digits that
is assigned to a name such as ``token`` or ``api_key``, in quotes or of at least 16 characters,
is a secret, a candidate with no such name in or near it is none, and what is in between is left
out of training.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.scratch import stage

MAX_DICTIONARY = 2_000  # a word is common when it makes up at least one of so many words
MAX_FINDINGS = 10_000  # labelled findings of each class that a forest is trained on
NEAR = 60  # characters before and after a candidate that are looked at
_SECRET = r"(?:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|auth|credentials?|private[_-]?key|access[_-]?key)"
# A name may go on after a sign or with a number, as in secret_access_key_1.
_NAME = _SECRET + r"(?:[_-][A-Za-z0-9_-]{0,20}|[0-9]{1,4})?[\"'`]?\s{0,3}(?::|=>?|:=)\s{0,3}"
# The cheap look at the character before comes first, so that the name is looked for at few places.
_VALUE = rf"(?<=[:=>\s\"'`])(?<=[:=>]\s{{0,3}}[\"'`]?)(?<=(?i:{_NAME})[\"'`]?)[^\s\"'`<>,;(){{}}\[\]&=:]" r"[^\s\"'`<>,;(){}\[\]&]{5,}+"
_CANDIDATE = (
    rf"{_VALUE}|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{{16,}}+(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?"
)
_PIECES = 21  # pieces of text that surely hold NEAR characters: a candidate has at least six, what follows it one
_NAMES = r"(?i)(token|secret|passw|pwd|api|auth|bearer|credential|private|access|key)"
_ASSIGNED = rf"(?i){_NAME}[\"'`]?$"
FEATURES = (
    "length", "runs", "digits", "capitals", "distinct", "coverage", "longest_word", "slashes", "in_address",
    "sample_path", "named", "assigned", "quoted", "hex_only", "digits_only",
)


def common_words(docs: DataFrame, text: str = "text", most: int = MAX_DICTIONARY) -> DataFrame:
    """``word`` for each run of 3 to 20 letters that is at least ``1 / most`` of them all, so at most ``most`` rows."""
    words = F.explode(F.split(F.lower(F.col(f"`{text}`").cast("string")), "[^a-z]+"))
    counts = docs.select(words.alias("word")).where(F.length("word").between(3, 20)).groupBy("word").count()
    counts = stage(counts, "words")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    return counts.where(F.col("count") * most >= F.lit(total)).select("word")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row for each candidate: ``key``, ``path``, ``nth`` in its text, ``candidate``, ``before``, ``after``.

    Whole texts are searched; null and empty texts have no candidates.
    """
    content = F.col(f"`{text}`").cast("string")
    where = F.col(f"`{path}`").cast("string") if path in docs.columns else F.lit(None).cast("string")
    found = docs.select(F.col(f"`{key}`").alias("key"), where.alias("path"), content.alias("text")).where(
        F.col("text").rlike(_CANDIDATE)
    )
    parts = found.select(
        "key",
        "path",
        F.regexp_extract_all("text", F.lit(_CANDIDATE), F.lit(0)).alias("found"),
        # What lies between the candidates: one more piece than there are candidates.
        F.split("text", _CANDIDATE, -1).alias("between"),
    )
    # The text again, piece by piece; only the ends of a piece can be near a candidate.
    pieces = F.flatten(
        F.transform("between", lambda b, i: F.array(b, F.coalesce(F.get("found", i), F.lit(""))))
    )
    parts = parts.select(
        "key",
        "path",
        "found",
        F.transform(pieces, lambda p: F.right(p, F.lit(NEAR))).alias("ends"),
        F.transform(pieces, lambda p: F.left(p, F.lit(NEAR))).alias("starts"),
    )

    def before(i: Column) -> Column:
        first = F.greatest(2 * i + 2 - _PIECES, F.lit(1))
        return F.right(F.array_join(F.slice("ends", first, 2 * i + 2 - first), ""), F.lit(NEAR))

    around = F.transform(
        "found",
        lambda c, i: F.struct(
            c.alias("candidate"),
            before(i).alias("before"),
            F.left(F.array_join(F.slice("starts", 2 * i + 3, F.lit(_PIECES)), ""), F.lit(NEAR)).alias("after"),
        ),
    )
    return parts.select("key", "path", F.posexplode(around).alias("nth", "x")).select(
        "key", "path", "nth", "x.candidate", "x.before", "x.after"
    )


def _share(pattern: str) -> Column:
    """The share of the candidate's characters that match."""
    return F.lit(1.0) - F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with a column for each of FEATURES; ``words`` is a dictionary of bounded size."""
    letters = F.filter(F.split(F.lower("candidate"), "[^a-z]+"), lambda w: F.length(w) >= 3)
    # At most MAX_DICTIONARY short words.
    dictionary = F.lit(sorted(r["word"] for r in words.collect())).cast("array<string>")
    known = F.array_intersect(letters, dictionary)
    covered = F.aggregate(known, F.lit(0), lambda total, w: total + F.length(w))
    flag = {
        "in_address": F.col("before").rlike(r"(://|www\.|[A-Za-z0-9._-]+/)\S*$") | F.col("after").rlike(r"^\.(html?|php|png|jpe?g|js)\b"),
        "sample_path": F.coalesce(F.col("path").rlike(r"(?i)(test|example|sample|fixture|mock|docs?)"), F.lit(False)),
        "named": F.concat_ws(" ", "before", "candidate", F.substring("after", 1, 20)).rlike(_NAMES),
        "assigned": F.col("before").rlike(_ASSIGNED),
        "quoted": F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]"),
        "hex_only": F.col("candidate").rlike("^[0-9a-fA-F]+$"),
        "digits_only": F.col("candidate").rlike("^[0-9]+$"),
    }
    return found.select(
        *found.columns,
        F.length("candidate").cast("double").alias("length"),
        (F.length(F.regexp_replace("candidate", "[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+", "x")) / F.length("candidate")).alias("runs"),
        _share("[0-9]").alias("digits"),
        _share("[A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate")).alias("distinct"),
        (covered / F.length("candidate")).alias("coverage"),
        F.coalesce(F.array_max(F.transform(letters, lambda w: F.length(w))), F.lit(0)).cast("double").alias("longest_word"),
        (F.length("candidate") - F.length(F.replace("candidate", F.lit("/")))).cast("double").alias("slashes"),
        *[F.coalesce(condition, F.lit(False)).cast("double").alias(name) for name, condition in flag.items()],
    )


def labelled(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1 where a value is assigned to a secret's name, 0 where no such name is in or near it."""
    mixed = (F.col("digits") > 0) & (F.col("digits") < 1)
    secret = (F.col("assigned") == 1) & mixed & ((F.col("quoted") == 1) | (F.col("length") >= 16))
    label = F.when(secret, 1.0).when((F.col("named") == 0) & (F.col("assigned") == 0), 0.0)
    return found.withColumn("label", label).where("label IS NOT NULL")


def fit(findings: DataFrame, most: int = MAX_FINDINGS, trees: int = 20, depth: int = 6) -> PipelineModel | None:
    """A forest from findings with FEATURES and ``label`` (0 or 1); None unless both labels occur.

    Findings that agree in all features are one row with their number as its weight.  At most
    ``most`` such rows of each label are used, those with the smallest hashes, so that the same
    table always gives the same forest and copies do not crowd out the rest.
    """
    distinct = stage(
        findings.groupBy("label", *FEATURES).agg(F.count("*").cast("double").alias("_weight")), "distinct-findings"
    )
    parts = []
    for label in (0.0, 1.0):
        own = distinct.where(F.col("label") == label)
        parts.append(own.orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(most))
    sample = stage(parts[0].unionByName(parts[1]), "labelled-findings")
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", weightCol="_weight", numTrees=trees, maxDepth=depth, seed=7, probabilityCol="_probability",
        rawPredictionCol="_raw", predictionCol="_prediction",
    )
    return PipelineModel([rows, forest.fit(rows.transform(sample))])


def find_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str = "source",
    findings: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Every candidate of every whole text: ``key, path, nth, candidate, before, after, score, is_secret``.

    ``score`` is the forest's share of trees for a secret.  ``findings`` are labelled rows with
    the columns of ``candidates`` and ``label``; without them labels are derived.  Where only
    one label occurs there is nothing to learn, and the score is whether it is assigned to a secret's name.
    Null texts have no candidates, a null path counts as no sample path, null keys and repeated
    rows are kept.  An empty table gives an empty result.
    """
    words = common_words(docs, text)
    found = stage(with_features(candidates(docs, key, text, path), words), "candidates")
    train = labelled(found) if findings is None else with_features(findings, words)
    model = fit(train)
    if model is None:
        score = F.col("assigned")
        scored = found.withColumn("score", score)
    else:
        scored = model.transform(found).withColumn("score", vector_to_array("_probability")[1])
    return scored.select(
        "key", "path", "nth", "candidate", "before", "after", "score", (F.col("score") >= threshold).alias("is_secret")
    )
