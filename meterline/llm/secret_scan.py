"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is what looks random: a key of a known form, a private key block, a value assigned to a telling name or said
to be one, a password in an address, or a long run of letters and digits. The forest reads its length, the kinds of its characters and how often they change, how much of it
is made of dictionary words, the path (here the source of the document) and the words beside it, all as columns. It is
trained on labelled findings; its trees then vote in the JVM. Everything is built-in functions and the library's forest.

Labelled findings come from the patterns that leave no doubt and from tokens that are certainly none (words, numbers,
repeated characters, dates, addresses), a bounded number of each, chosen by a hash. A null or empty text has no
finding. A text in which one value stands several times has a finding per place. Without findings of both labels every
candidate stays. An empty table gives an empty result. Further columns are not passed on.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import hashed_sample, stored

# Forms of keys that are secrets beyond doubt.
KNOWN_FORMS = (
    r"AKIA[0-9A-Z]{16}",
    r"gh[pousr]_[0-9A-Za-z]{36}",
    r"xox[abprs]-[0-9A-Za-z-]{10,}",
    r"eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}",
)
# Words that make a name tell of a secret wherever they stand in it; the values assigned to such names are candidates.
TELLING = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?!ors?(?![a-z]))|credential|private[_-]?key"
# Syllables of common words, for the share of a token that a dictionary covers.
COMMON_PARTS = "the|and|ing|ion|tion|ent|ate|est|ere|her|that|for|with|der|die|und|sch|ein|que|les|des|ment|los|las|con|cion|ar|er|en|an|on|in|or|re|at|it|is|al"

_IN_NAME = "[A-Za-z0-9_.-]"
# A name that tells and something that is assigned to it. The padding of a long token is no assignment.
_TELLING_NAME = (
    r"(?=" + _IN_NAME + r"++[\"']?\s*[=:])(?=" + _IN_NAME + r"*?(?i:" + TELLING + r"))"
    r"(?!(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{16,}={1,2}(?:[\s\"',;)}\]<&]|$))"
)
# A private key from its first line to its last; a hyphen stands in its headers a few times at most.
_KEY_BODY = r"[A-Za-z0-9+/=\s\\:,.]*+"
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----" + _KEY_BODY + "(?:-(?!-)" + _KEY_BODY + r"){0,12}+-----END [A-Z ]{0,40}PRIVATE KEY-----"
)
# The part of an address before the password in it, and a sentence before one.
_ADDRESS = r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,20}+://[^\s:/@]++:"
_SENTENCE = r"(?i:" + TELLING + r")[\"']?\s{1,4}(?i:is|was)\s{1,4}[\"']?"
# In each alternative the value is the only group and ends the match.
CANDIDATE = (
    "(" + PRIVATE_KEY + ")|" + _ADDRESS + r"([^\s/@]{4,}+)(?=@)"
    + r"|\b(" + "|".join(KNOWN_FORMS) + r")|(?<!" + _IN_NAME + r")(?<!://)" + _TELLING_NAME + _IN_NAME
    + r"++[\"']?\s*[=:]=?>?\s*[\"']?([^\s\"',;]{6,})"
    + "|" + _SENTENCE + r"((?=[^\s\"',;]{0,200}[0-9])[^\s\"',;]{5,}[^\s\"',;.!?)])"
    + r"|(?<![A-Za-z0-9_@./-])(?!(?:[A-Za-z0-9+/_-]*[+/])?"
    + _TELLING_NAME + r")([A-Za-z0-9+/_-]{16,}={0,2})(?![A-Za-z0-9@_-])"
)
GROUPS = 6
# Words that say a value is none; a host like mail.example.com beside it says nothing.
PRETENDED = r"(?<![.@a-z0-9])(example|sample|dummy|placeholder|changeme|your[_-])|changeme|xxxx"

# What stands before and after a candidate is kept up to this many characters, other candidates or not: the words that
# speak for it or against it.
CONTEXT = 40
# Every second part of a text is a match of at least six characters, so these hold that many.
NEAR_PARTS = 2 * -(-CONTEXT // 6) + 1
# Places are summed in chunks of so many candidates, so that their cost grows with the candidates of a text and no faster.
CHUNK = 256

# Labelled findings of each label that training reads at most. Scanning has no bound.
TRAINING_FINDINGS = 5000
TREES, DEPTH, SEED = 30, 7, 11
LEAST_PROBABILITY = 0.5

FEATURES = (
    "length", "digits", "uppers", "lowers", "others", "changes", "distinct", "covered", "hex_only", "assigned", "quoted",
    "telling", "known_form", "example", "path_test", "path_config",
)


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: ``doc_id, path, start, value, before, after``; starts count code points.

    The text is cut at its candidates once; what lies between gives the places.
    """
    where = F.col(path) if path in docs.columns else F.lit(None).cast("string")
    taken = docs.select(F.col(doc_id).alias("doc_id"), where.alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Only some texts have a candidate; a plain test is cheaper than cutting.
    having = taken.where(F.col("text").rlike(CANDIDATE))
    cut = having.select(
        "doc_id", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), 0).alias("whole"), F.split("text", CANDIDATE).alias("between"),
    )
    # Each part between and each whole match in turn; a match ends after all that went before and itself.
    sizes = F.zip_with(F.slice("between", 1, F.size("whole")), "whole", lambda gap, hit: F.length(gap) + F.length(hit))
    cut = cut.select("*", sizes.alias("sizes"))
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("sizes") - 1) / CHUNK).cast("int")), lambda at: _sums(F.slice("sizes", at * CHUNK + 1, F.lit(CHUNK)))
    )
    cut = cut.select("doc_id", "path", "whole", "between", chunks.alias("chunks"))
    earlier = F.slice(_sums(F.transform("chunks", lambda sums: F.element_at(sums, -1))), 1, F.size("chunks"))
    ends = F.flatten(F.zip_with("chunks", earlier, lambda sums, start: F.transform(F.slice(sums, 2, CHUNK), lambda one: one + start)))
    # All parts in their order, without what is in the middle of a long one, as only its ends are context of others.
    parts = F.flatten(F.zip_with("between", "whole", lambda gap, hit: F.array(gap, F.coalesce(hit, F.lit("")))))
    parts = F.transform(
        parts,
        lambda one: F.when(F.length(one) <= 2 * CONTEXT, one).otherwise(F.concat(F.left(one, F.lit(CONTEXT)), F.right(one, F.lit(CONTEXT)))),
    )
    # The match at a place is part 2 * place + 2, counted from 1; beside it so many parts hold the context.
    before = lambda place: F.slice("parts", F.greatest(2 * place + 2 - NEAR_PARTS, F.lit(1)), F.least(2 * place + 1, F.lit(NEAR_PARTS)))
    after = lambda place: F.slice("parts", 2 * place + 3, F.lit(NEAR_PARTS))
    rows = cut.select("doc_id", "path", "whole", ends.alias("ends"), parts.alias("parts")).select(
        "doc_id", "path",
        F.explode(
            F.transform(
                "whole",
                lambda hit, place: F.struct(
                    hit.alias("whole"),
                    (F.get("ends", place) - F.length(hit)).alias("at"),
                    F.right(F.array_join(before(place), ""), F.lit(CONTEXT)).alias("text_before"),
                    F.left(F.array_join(after(place), ""), F.lit(CONTEXT)).alias("after"),
                ),
            )
        ).alias("one"),
    )
    # The sign after a password in an address is not part of the match.
    patterns = [(f"^{_ADDRESS}([^\\s/@]+)$", 1), *((CANDIDATE, group) for group in range(1, GROUPS + 1))]
    value = F.coalesce(*[F.nullif(F.regexp_extract("one.whole", pattern, group), F.lit("")) for pattern, group in patterns])
    before_value = F.length("one.whole") - F.length(value)
    # The value ends its match, so the rest of the match stands before it.
    return rows.select(
        "doc_id", "path", (F.col("one.at") + before_value).cast("bigint").alias("start"), value.alias("value"),
        F.concat(F.coalesce("one.text_before", F.lit("")), F.left("one.whole", before_value)).alias("before"),
        F.coalesce("one.after", F.lit("")).alias("after"),
    )


def _sums(numbers: Column) -> Column:
    """0 and the sums of the first, the first two and so on of an array."""
    return F.aggregate(numbers, F.array(F.lit(0)), lambda sums, one: F.concat(sums, F.array(F.element_at(sums, -1) + one)))


def _count(value: Column, pattern: str) -> Column:
    return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))


def described(found: DataFrame) -> DataFrame:
    """Adds the features, numbers from 0 on."""
    value, before = F.col("value"), F.lower("before")
    length = F.length(value)

    def share(count: Column) -> Column:
        return count / F.greatest(length, F.lit(1))

    # One mark per character kind, so that a change of kind is a change of letter.
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d")
    runs = F.regexp_replace(kinds, r"(.)\1+", "$1")
    path = F.lower(F.coalesce("path", F.lit("")))
    return found.select(
        "*",
        length.cast("double").alias("length"),
        share(_count(value, "[0-9]")).alias("digits"),
        share(_count(value, "[A-Z]")).alias("uppers"),
        share(_count(value, "[a-z]")).alias("lowers"),
        share(_count(value, "[^0-9A-Za-z]")).alias("others"),
        share(F.length(runs)).alias("changes"),
        share(F.size(F.array_distinct(F.split(value, "")))).alias("distinct"),
        share(_count(F.lower(value), COMMON_PARTS)).alias("covered"),
        value.rlike("^[0-9a-f]+$").cast("double").alias("hex_only"),
        before.rlike(r"([=:]>?|\s(is|was))\s*[\"']?$").cast("double").alias("assigned"),
        before.rlike("[\"']$").cast("double").alias("quoted"),
        before.rlike(rf"({TELLING})|://[^\s:/@]+:$").cast("double").alias("telling"),
        value.rlike("^((" + "|".join(KNOWN_FORMS) + ")$|-----BEGIN )").cast("double").alias("known_form"),
        F.concat(before, F.lower("value"), F.lower("after")).rlike(PRETENDED).cast("double").alias("example"),
        path.rlike("test|spec|mock|fixture|doc").cast("double").alias("path_test"),
        path.rlike("conf|env|deploy|prod|secret").cast("double").alias("path_config"),
    )


def labelled(described_findings: DataFrame) -> DataFrame:
    """Findings whose label is beyond doubt, with ``label`` 1.0 or 0.0."""
    value = F.col("value")
    known = F.col("known_form") == 1
    told = (F.col("telling") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0.15) & (F.col("changes") > 0.3) & (F.col("distinct") > 0.2)
    word = (F.col("digits") == 0) & ((F.col("covered") > 0.4) | value.rlike("^([A-Z]?[a-z]+|[A-Z]+)([_/+-]+[A-Za-z]+)*$"))
    plain = value.rlike("^[0-9+/_-]+$") | value.rlike(r"^(.)\1+$") | (F.col("example") == 1) | (F.col("distinct") < 0.1)
    return described_findings.withColumn("label", F.when(known, 1.0).when(word | plain, 0.0).when(told, 1.0)).where("label IS NOT NULL")


def train(described_findings: DataFrame) -> PipelineModel | None:
    """A forest from at most TRAINING_FINDINGS findings of each label, chosen by a hash; None without both labels."""
    marked = labelled(described_findings).select(*FEATURES, "label", F.xxhash64("value", "before").alias("hash"))
    chosen = [
        hashed_sample(marked.where(F.col("label") == label), F.col("hash"), TRAINING_FINDINGS).select(*FEATURES, "label") for label in (0.0, 1.0)
    ]
    rows = stored(chosen[0].unionByName(chosen[1]).coalesce(1), "labelled-findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="probability"
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(rows)


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Candidates that the forest does not remove: ``doc_id, start, length, value_sha256, kind, probability``."""
    from pyspark.ml.functions import vector_to_array

    found = stored(described(findings(docs, doc_id, text, path)), "candidates")
    model = train(found)
    if model is None:
        judged = found.withColumn("chance", F.lit(1.0))
    else:
        judged = model.transform(found).withColumn("chance", F.get(vector_to_array("probability"), 1))
    value = F.col("value")
    kind = F.when(F.col("known_form") == 1, "known_form").when(F.col("telling") == 1, "assigned").otherwise("random")
    return judged.where(F.col("chance") >= LEAST_PROBABILITY).select(
        "doc_id", "start", F.length(value).cast("bigint").alias("length"), F.sha2(value, 256).alias("value_sha256"),
        kind.alias("kind"), F.col("chance").alias("probability"),
    )
