"""URL filters: host rules, and gradient-boosted trees on lexical features for URLs that no rule decides.

Everything here is DataFrame functions and DataFrame-based learning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import ascii_lower, saved, table

# (verdict, host, path): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# The trees are fitted on at most this many labelled URLs, chosen by hash.
TRAIN_ROWS = 20_000
ROUNDS, DEPTH, SEED = 12, 4, 11
# Whole hosts are dealt to folds: a training row sees suffix counts of the other folds only.
FOLDS = 5
# A suffix's share of blocked URLs is drawn to the mean as by this many rows.
PRIOR_ROWS = 5
FEATURES = [
    "url_length", "host_length", "path_depth", "digit_share", "entropy", "parameters", "host_parts", "host_hyphens", "suffix_share", "suffix_rows",
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)


def rule_column(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits as (rule, verdict); null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        chosen = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def with_features(urls: DataFrame) -> DataFrame:
    """Lexical features of ``url``, ``host`` and ``path``, and the host's last two parts as ``suffix``."""
    length = F.length("url").cast("double")
    chars = F.split("url", "")
    # runs of the sorted characters: log2(n) less the mean of log2(run), in one pass over a URL of any length
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))
    weight = lambda run: F.when(run > 0, run * F.log2(run)).otherwise(0.0)
    step = lambda s, c: F.struct(
        c.alias("last"),
        F.when(c == s["last"], s["run"] + 1.0).otherwise(1.0).alias("run"),
        F.when(c == s["last"], s["total"]).otherwise(s["total"] + weight(s["run"])).alias("total"),
    )
    runs = F.aggregate(F.array_sort(chars), start, step, lambda s: s["total"] + weight(s["run"]))
    entropy = F.when(length > 0, F.log2(length) - runs / length).otherwise(0.0)
    parts = F.split("host", r"\.")
    return urls.withColumns(
        {
            "url_length": length,
            "host_length": F.length("host").cast("double"),
            "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
            "digit_share": F.regexp_count("url", F.lit("[0-9]")) / F.greatest(length, F.lit(1.0)),
            "entropy": entropy,
            "parameters": F.regexp_count("url", F.lit(r"[?&][^=&#]+=")).cast("double"),
            "host_parts": F.size(parts).cast("double"),
            "host_hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
            "suffix": F.substring_index("host", ".", -2),
        }
    )


def labelled_urls(pages: DataFrame, rules: tuple = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(url, host, path, label, fold): at most ``train_rows`` distinct URLs that a rule decides, 1 for block, chosen by hash."""
    urls = _split(pages, rules).where("ruled IS NOT NULL")
    rows = urls.select("url", "host", "path", (F.col("ruled.verdict") == "block").cast("double").alias("label")).distinct()
    fold = F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")
    return saved(rows.orderBy(F.xxhash64("url"), "url").limit(train_rows).withColumn("fold", fold))


def _split(pages: DataFrame, rules: tuple) -> DataFrame:
    url = F.coalesce(pages["url"].cast("string"), F.lit(""))
    urls = pages.select(*[pages[c] for c in pages.columns if c == "page_id"], url.alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return urls.withColumn("ruled", rule_column(F.col("host"), F.col("path"), rules))


class UrlTrees:
    """Gradient-boosted trees fitted on labelled URLs, with the suffix statistics they were fitted on."""

    def __init__(self, sample: DataFrame):
        from pyspark.ml.classification import GBTClassifier

        known = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        self.only = None if len(known) == 2 else float(bool(known.get(1.0)))
        if self.only is not None:
            return
        self.rate = known[1.0] / sum(known.values())
        rows = with_features(sample)
        cells = rows.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("b"))
        totals = cells.groupBy(F.col("suffix").alias("_suffix")).agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        self.suffixes = saved(totals.select("_suffix", *self._statistics(F.col("all_n"), F.col("all_b"))))
        others = cells.join(totals, F.col("suffix") == F.col("_suffix")).select(
            "_suffix", F.col("fold").alias("_fold"), *self._statistics(F.col("all_n") - F.col("n"), F.col("all_b") - F.col("b"))
        )
        unseen = saved(rows.join(others, (F.col("suffix") == F.col("_suffix")) & (F.col("fold") == F.col("_fold"))))
        self.model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=SEED).fit(self._assembled(unseen).select("label", "features"))

    def _statistics(self, n: Column, blocked: Column) -> list[Column]:
        return [n.cast("double").alias("suffix_rows"), ((blocked + self.rate * PRIOR_ROWS) / (n + PRIOR_ROWS)).alias("suffix_share")]

    @staticmethod
    def _assembled(rows: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler

        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)

    def score(self, urls: DataFrame) -> DataFrame:
        """``urls`` (url, host, path, ..) with ``_score``, the probability of block; null if only one verdict is known."""
        from pyspark.ml.functions import vector_to_array

        if self.only is not None:
            return urls.withColumn("_score", F.lit(None).cast("double"))
        met = with_features(urls).join(self.suffixes, F.col("suffix") == F.col("_suffix"), "left")
        met = met.fillna({"suffix_rows": 0.0, "suffix_share": self.rate})
        return self.model.transform(self._assembled(met)).withColumn("_score", vector_to_array("probability")[1])


def held_out_accuracy(pages: DataFrame, rules: tuple = RULES, train_rows: int = TRAIN_ROWS) -> tuple[int, float]:
    """(URLs, share judged as their rules do) of the hosts of one fold, whose URLs the trees have not seen."""
    sample = labelled_urls(pages, rules, train_rows)
    judged = UrlTrees(sample.where("fold > 0")).score(sample.where("fold = 0"))
    right = F.avg(((F.col("_score") >= 0.5).cast("double") == F.col("label")).cast("double"))
    return tuple(judged.agg(F.count("*"), right).first())


def url_filter(pages: DataFrame, rules: tuple = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score.

    Where a rule fits, the longest decides and ``score`` is null. Elsewhere ``score`` is the trees' probability of block,
    and the verdict is block from one half. The trees learn from URLs that rules have labelled, a sample of at most
    ``train_rows`` distinct ones, including how often its suffix was blocked: for a training row that is counted over
    the hosts of other folds, for a page over all. If the sample does not have both verdicts, the one it has (else allow)
    holds for all. URLs without ``://`` and null ones have an empty host and path, no rule, and are judged by their
    features, of which an empty URL has zeros; long URLs are read whole, in time about proportional to their length.
    ``pages`` is scanned twice: for the sample, which is stored, and for the result. Nothing else is shuffled but the
    join of suffixes where these are too many to send. Repeated rows are judged row by row; an empty table gives an empty result;
    other columns are ignored.
    """
    trees = UrlTrees(labelled_urls(pages, rules, train_rows))
    shown = _split(pages, rules).select("page_id", "host", "path", F.col("ruled.rule").alias("rule"), F.col("ruled.verdict").alias("verdict"), "url")
    score = F.when(F.col("rule").isNull(), F.col("_score"))
    judged = F.lit("block" if trees.only else "allow") if trees.only is not None else F.when(score >= 0.5, "block").otherwise("allow")
    return trees.score(shown).select("page_id", "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"), score.alias("score"))


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))
