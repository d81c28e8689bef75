"""Quality rules of texts, and the verdict on the hosts they come from.

Each text is measured by built-in expressions in one scan. Rule failures are counted per host; as rates of small hosts
say little, each is shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts themselves, by the
mean and the spread of their rates. A host whose shrunk rate is above a limit is refused, and its verdict goes back to
its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.native import WHITE_SPACE, bound_once, whole
from tabloom.session import BROADCAST_ROWS, small_side, stash

WINDOW_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words in repeated windows
MOST_SYMBOLS = 10  # symbols for a hundred words
MOST_DUPLICATE_LINES = 30  # percent of lines with a word
HOST_LIMIT = 0.5
# The symbols that are counted, the characters between words.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"

RULES = ("few_words", "repeats", "symbols", "duplicate_lines")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE_SPACE), lambda w: w != "")


def repeated_words(words: Column, size: int = WINDOW_WORDS) -> Column:
    """Number of words that stand in a window of so many words which the text holds twice or more.

    Windows are told apart by 64-bit hashes. Only where two are equal are they sorted; the starts of repeated windows, in
    order, then cover at most size words each, less where the next one starts earlier.
    """
    n = F.size(words)

    def covered(hashes: Column) -> Column:
        def starts(sorted_: Column) -> Column:
            def repeated(entry: Column, k: Column) -> Column:
                beside = lambda at: F.coalesce(F.get(sorted_, at)["hash"] == entry["hash"], F.lit(False))
                return beside(k - 1) | beside(k + 1)

            return F.sort_array(F.transform(F.filter(sorted_, repeated), lambda e: e["at"]))

        def total(at: Column) -> Column:
            return F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - x, F.lit(size)))), F.lit(0), lambda s, x: s + x)

        entries = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("hash"), k.alias("at"))))
        alike = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(alike, F.lit(0)).otherwise(bound_once(bound_once(entries, starts), total))

    def windows(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(own) - size), lambda k: F.xxhash64(*[F.get(own, k + j) for j in range(size)]))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(n <= size, F.lit(0)).otherwise(bound_once(bound_once(hashed, windows), covered)).cast("long")


def measures(docs: DataFrame, *, text_col: str, keep: list[Column]) -> DataFrame:
    """The kept columns with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of whole texts."""
    text = whole(F.col(text_col))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, WHITE, "") != "")
    rows = docs.select(
        *keep,
        bound_once(_words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))).alias("_of_words"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bound_once(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), F.size(F.array_distinct(x)).cast("long").alias("_kinds"))).alias("_of_lines"),
    )
    own = [c for c in rows.columns if not c.startswith("_of_")]
    rows = rows.select(*own, "_of_words.*", "_of_lines.*")
    return rows.withColumn("n_dup_lines", F.col("n_lines") - F.col("_kinds")).drop("_kinds")


def rule_failures() -> dict[str, Column]:
    """Whether a row of measures fails each rule."""
    n = F.col("n_words")
    return {
        "few_words": n < LEAST_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MOST_REPEATED * n,
        "symbols": 100 * F.col("n_symbols") > MOST_SYMBOLS * n,
        "duplicate_lines": 100 * F.col("n_dup_lines") > MOST_DUPLICATE_LINES * F.col("n_lines"),
    }


def beta_prior(hosts: DataFrame, failed: str, total: str = "n_docs") -> tuple[float, float]:
    """(alpha, beta) of the hosts' failure rates by their moments, in one aggregate.

    The mean is that of all documents. The spread between hosts is what their rates vary by, weighted by documents,
    beyond what counting alone makes them vary by; without any, or with one host, the prior is as strong as all
    documents, so every host gets the mean.
    """
    n, k = F.col(total).cast("double"), F.col(failed).cast("double")
    sums = hosts.agg(F.count("*").alias("hosts"), F.sum(n).alias("n"), F.sum(k).alias("k"), F.sum(n * n).alias("nn"), F.sum(k * k / n).alias("kkn")).first()
    if not sums["n"]:
        return 1.0, 1.0
    mean = sums["k"] / sums["n"]
    between = sums["kkn"] - sums["n"] * mean * mean - (sums["hosts"] - 1) * mean * (1 - mean)
    room = sums["n"] - sums["nn"] / sums["n"] - (sums["hosts"] - 1)
    spread = between / room if room > 0 else 0.0
    strength = mean * (1 - mean) / spread - 1 if spread > 0 else sums["n"]
    strength = min(max(strength, 1.0), float(sums["n"]))
    return mean * strength, (1 - mean) * strength


def host_verdicts(rows: DataFrame, *, host_col: str, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, failures of each rule and of any, shrunk rate of each, refused) of every host; null is a host too."""
    rules = rule_failures()
    any_rule = F.lit(False)
    for failed in rules.values():
        any_rule = any_rule | failed
    counts = {f"failed_{name}": F.sum(failed.cast("long")) for name, failed in (rules | {"any": any_rule}).items()}
    hosts = stash(rows.groupBy(F.col(host_col).alias("host")).agg(F.count("*").alias("n_docs"), *[v.alias(k) for k, v in counts.items()]))
    rates = {}
    for name in counts:
        alpha, beta = beta_prior(hosts, name)
        rates[name.replace("failed_", "rate_")] = (F.col(name) + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    return hosts.withColumns(rates).withColumn("refused", F.col("rate_any") > limit)


def with_verdicts(rows: DataFrame, verdicts: DataFrame, *, host_col: str) -> DataFrame:
    """rows with refused of their host.

    Hosts that hold a hundred-thousandth of all documents or more, of which there are no more than that, are broadcast;
    all others have few rows each and are joined by a shuffle, if there are any.
    """
    told = stash(verdicts.select(F.col("host").alias("_host"), "n_docs", "refused"))
    total = told.agg(F.sum("n_docs")).first()[0] or 0
    least = -(-total // BROADCAST_ROWS)
    large = F.broadcast(told.filter(F.col("n_docs") >= least).select("_host", F.col("refused").alias("_large")))
    met = rows.join(large, F.col(host_col).eqNullSafe(F.col("_host")), "left").drop("_host")
    small = told.filter(F.col("n_docs") < least)
    if small.isEmpty():
        return met.withColumn("refused", F.coalesce("_large", F.lit(False))).drop("_large")
    names = met.columns
    rest = met.filter(F.col("_large").isNull()).join(small_side(small.select("_host", "refused")), F.col(host_col).eqNullSafe(F.col("_host")), "left").select(*names, "refused")
    return met.filter(F.col("_large").isNotNull()).withColumn("refused", F.col("_large")).unionByName(rest).drop("_large")


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_refused, kept of every row.

    base_failed: fewer than LEAST_WORDS words, or more than MOST_REPEATED percent of them in repeated windows. kept is
    false for these and for all documents of a host that is refused. Null and empty texts have no words, so they fail;
    null is a host of its own. Rows count one by one, repeated ones too. An empty table gives none.
    """
    rows = stash(measures(docs, text_col=text_col, keep=[F.col(id_col).alias("_id"), F.col(host_col).alias("_from")]))
    told = with_verdicts(rows, host_verdicts(rows, host_col="_from", limit=limit), host_col="_from")
    rules = rule_failures()
    failed = rules["few_words"] | rules["repeats"]
    return told.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.col("refused").alias("host_refused"), (~failed & ~F.col("refused")).alias("kept"),
    )
