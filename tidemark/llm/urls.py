"""URL verdicts with DataFrame functions alone: host and path rules, then gradient-boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean_disk, materialize

TRAINING_ROWS = 20_000  # about the most labelled URLs that the trees are fitted on
LEAST_ROWS = 1_000  # of them for a rare label, if there are so many
BROADCAST_SUFFIXES = 100_000  # most suffixes that go to every task; more are joined by a shuffle
TREES = 12
DEPTH = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = [
    "f_length", "f_host_length", "f_depth", "f_labels", "f_digits", "f_host_digits", "f_hyphens", "f_entropy",
    "f_host_entropy", "f_parameters", "f_fragment", "f_suffix_seen", "f_suffix_rate",
]


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and a path's beginning, written host/path."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        own, _, rest = self.text.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)


def _rest(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substring(url, start + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, both null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        text = F.when(r.fits(host, path), F.lit(r.text)).otherwise(text)
        verdict = F.when(r.fits(host, path), F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits for each character."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    shares = F.transform(
        F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)
    )
    return F.aggregate(shares, F.lit(0.0), lambda sum_, p: sum_ - p * F.log2(p))


def _share(text: Column, kind: str) -> Column:
    n = F.length(text)
    return F.when(n > 0, F.length(F.regexp_replace(text, f"[^{kind}]", "")) / n).otherwise(F.lit(0.0))


def lexical(df: DataFrame, url: str) -> DataFrame:
    """``df`` with the columns of FEATURES that the URL alone gives, ``_suffix`` and what they are made from."""
    text = F.coalesce(F.col(url), F.lit(""))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    df = df.withColumn("_host", host).withColumn("_path", path).withColumn("_query", F.regexp_extract(text, r"\?([^#]*)", 1))
    return df.withColumns(
        {
            "_suffix": F.substring_index("_host", ".", -1),
            "f_length": F.length(text).cast("double"),
            "f_host_length": F.length("_host").cast("double"),
            "f_depth": F.size(F.filter(F.split("_path", "/"), lambda p: p != "")).cast("double"),
            "f_labels": F.size(F.split("_host", r"\.")).cast("double"),
            "f_digits": _share(text, "0-9"),
            "f_host_digits": _share(F.col("_host"), "0-9"),
            "f_hyphens": (F.length("_host") - F.length(F.replace(F.col("_host"), F.lit("-"), F.lit("")))).cast("double"),
            "f_entropy": _entropy(text),
            "f_host_entropy": _entropy(F.col("_host")),
            "f_parameters": F.size(F.filter(F.split("_query", "&"), lambda p: p != "")).cast("double"),
            "f_fragment": F.contains(text, F.lit("#")).cast("double"),
        }
    )


@dataclass(frozen=True)
class UrlModel:
    trees: GBTClassificationModel | None  # none where the labels have one class only
    default: float  # the probability of a block then
    suffixes: DataFrame  # _suffix, f_suffix_seen, f_suffix_rate
    few: bool  # whether the suffixes may go to every task
    rate: float


def _assembled(df: DataFrame, suffixes: DataFrame, few: bool, rate: float) -> DataFrame:
    df = df.join(F.broadcast(suffixes) if few else suffixes, "_suffix", "left").fillna({"f_suffix_seen": 0.0, "f_suffix_rate": rate})
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(df)


def fit(labelled: DataFrame, url: str = "url", label: str = "blocked") -> UrlModel:
    """Trees on a sample of about TRAINING_ROWS labelled URLs; ``label`` is 1 for block, 0 for allow.

    Rows with a null label are left out; a null URL is an empty one. Repeated rows weigh as often as they occur. Without
    rows of both labels the model gives their common label, or allow if there are none. Suffix statistics are the number of
    labelled URLs with the host's last label and the smoothed share of blocks among them, over all labelled rows.
    """
    lean_disk(labelled.sparkSession)
    rows = labelled.filter(F.col(label).isNotNull()).select(F.coalesce(url, F.lit("")).alias("_url"), F.col(label).cast("double").alias("label"))
    counted = materialize(rows.groupBy("_url", "label").agg(F.count("label").alias("_n")), "url-labels")
    suffix = F.substring_index(host_of(F.col("_url")), ".", -1)
    sums = counted.groupBy(suffix.alias("_suffix")).agg(
        F.sum("_n").alias("_all"), F.sum(F.when(F.col("label") > 0, F.col("_n")).otherwise(0)).alias("_blocked")
    )
    sums = materialize(sums, "url-suffix-counts")
    seen = sums.agg(F.sum("_all").alias("n"), F.sum("_blocked").alias("blocked"), F.count("_all").alias("suffixes")).first()
    n, blocked, few = seen.n or 0, seen.blocked or 0, seen.suffixes <= BROADCAST_SUFFIXES
    rate = blocked / n if n else 0.0
    suffixes = sums.select(
        "_suffix",
        F.col("_all").cast("double").alias("f_suffix_seen"),
        ((F.col("_blocked") + 10 * rate) / (F.col("_all") + 10)).alias("f_suffix_rate"),
    )
    trees = None
    if 0 < rate < 1:
        sample = _assembled(materialize(lexical(_sample(counted, n, blocked), "_url"), "url-training"), suffixes, few, rate)
        learner = GBTClassifier(
            featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=TREES, maxDepth=DEPTH, seed=7, maxBins=64
        )
        trees = learner.fit(sample.select("_features", "label", "_weight"))
    return UrlModel(trees, rate, suffixes, few, rate)


def _sample(counted: DataFrame, n: int, blocked: int) -> DataFrame:
    """(_url, label, _weight): about TRAINING_ROWS of the ``n`` rows behind (_url, label, _n), drawn for each label apart.

    Of a URL's copies the same share is drawn as of all rows, the odd one by the URL's hash; so the sample depends on the
    rows alone. A rare label has a larger share and a smaller weight.
    """
    usual = min(1.0, TRAINING_ROWS / n)
    shares = [min(1.0, max(usual, LEAST_ROWS / of)) for of in (n - blocked, blocked)]
    share = F.when(F.col("label") > 0, shares[1]).otherwise(shares[0])
    draw = F.pmod(F.xxhash64("_url", "label"), F.lit(1 << 32)) / float(1 << 32)
    drawn = counted.withColumn("_copies", F.floor(F.col("_n") * share + draw).cast("int")).filter(F.col("_copies") > 0)
    return drawn.select("_url", "label", (usual / share).alias("_weight"), F.explode(F.sequence(F.lit(1), "_copies"))).drop("col")


def judge(df: DataFrame, model: UrlModel, rules: Sequence[Rule], url: str = "url", threshold: float = 0.5) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``p_block`` and ``verdict``.

    The longest rule that fits decides; where none does, the model blocks at ``threshold``. A null URL or one without
    ``://`` has an empty host and path and is left to the model. Repeated rows are judged alike; an
    empty table gives no rows. Other columns pass through, those names and ``f_*`` are replaced.
    """
    added = ["host", "path", "rule", "p_block", "verdict"]
    df = df.drop(*added, *FEATURES)
    own = [F.col(f"`{c}`") for c in df.columns]
    rows = _assembled(lexical(df, url), model.suffixes, model.few, model.rate)
    if model.trees is None:
        p = F.lit(model.default)
    else:
        rows = model.trees.transform(rows)
        p = vector_to_array("probability")[1]
    text, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    return rows.select(
        *own,
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        text.alias("rule"),
        p.alias("p_block"),
        F.coalesce(verdict, F.when(p >= threshold, "block").otherwise("allow")).alias("verdict"),
    )
