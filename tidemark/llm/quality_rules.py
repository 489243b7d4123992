"""Quality rules as a ledger of failure bits.

``ledger`` evaluates every rule once per document and stores one integer whose bits say which rules
failed, beside the measurements the rules look at. A policy is a mask over these bits with a version
name, so a new policy, or the effect of dropping one rule, is a bitwise test over the stored integer:
no text is read again.

All of it is row-local DataFrame work on the JVM. Repeated three-word windows are found inside the row
by sorting (window hash, position) packed in one long per window, so a text of n words costs n log n and
nothing is shuffled, however skewed the sources are.

Defined cases: NULL or empty text has no words and fails ``few_words``; texts of one or two words have
no window; every row is judged on its own, so repeated rows and ties get equal verdicts; columns of the
input that clash with measurement names are not kept (only the id is carried).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import BLANKS, SPACE, whole, without, words

SYMBOLS = "#*$%&|<>"

#: Rule name -> condition over the measurements. The order fixes the bit of each rule.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 5 * word_chars",
    "capitals": "100 * n_upper > 50 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "long_words": "word_chars > 40 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
#: Policy version -> the rules it enforces.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")


def mask(policy: str) -> int:
    """The bits a policy enforces."""
    return sum(BIT[r] for r in POLICIES[policy])


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns :data:`MEASURES`, each computed once from the whole text."""
    df = docs.withColumn("_t", whole(F.col(text)))
    df = df.withColumn("_w", words(F.col("_t"))).withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: without(x, BLANKS) != ""))
    df = df.withColumn("n_words", F.size("_w").cast("long"))
    # A window's key: the high bits of its hash, then its position in just as many low bits as positions need.
    df = df.withColumn("_b", F.length(F.bin("n_words")))
    keys = F.expr("transform(sequence(0, size(_w) - 3), "
                  "i -> shiftleft(xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2)), _b) | cast(i as bigint))")
    df = df.withColumn("_k", F.when(F.size("_w") >= 3, F.sort_array(keys)).otherwise(F.expr("cast(array() as array<bigint>)")))
    df = df.withColumn("_p", F.expr(
        "sort_array(transform(filter(_k, (x, i) -> {}), x -> x & (shiftleft(1L, _b) - 1)))".format(" or ".join(
            f"((x ^ get(_k, i {d} 1)) < shiftleft(1L, _b) and (x ^ get(_k, i {d} 1)) >= 0 and {_same('x', f'get(_k, i {d} 1)')})" for d in "-+"))))
    repeats = F.expr("aggregate(transform(_p, (p, i) -> least(3L, coalesce(get(_p, i + 1) - p, 3L))), 0L, (a, x) -> a + x)")
    t = F.col("_t")
    return df.withColumns({
        "word_chars": F.length(without(t, BLANKS)).cast("long"),
        "n_symbols": (F.length(t) - F.length(without(t, SYMBOLS))).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": repeats,
        "n_upper": F.regexp_count(t, F.lit("\\p{Lu}")).cast("long"),
        "n_lines": F.size("_l").cast("long"),
    }).drop("_t", "_w", "_l", "_b", "_k", "_p")


def _same(x: str, y: str) -> str:
    """SQL: two window keys stand for the same three words (the hash bits alone could collide)."""
    at = [f"cast({k} & (shiftleft(1L, _b) - 1) as int)" for k in (x, y)]
    return " and ".join(f"get(_w, {at[0]} + {d}) = get(_w, {at[1]} + {d})" for d in range(3))


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: the key, :data:`MEASURES` and ``failed_bits`` (bit i: rule i failed).

    The one-row explode is a barrier: a policy's filter stays above the ledger, instead of being moved below the
    measurements, where their definitions would be written out inside each other and evaluated per word.
    """
    measured = measure(docs.select(F.col(key), F.col(text)), text).drop(text)
    bits = F.lit(0)
    for name, rule in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(rule), BIT[name]).otherwise(0))
    entry = F.struct(*MEASURES, bits.alias("failed_bits"))
    return measured.select(key, F.explode(F.array(entry)).alias("_entry")).select(key, "_entry.*")


def verdict(policy: str) -> Column:
    """True where a ledger row passes the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents failing it, and documents that only it rejects (what dropping it would keep)."""
    m = mask(policy)
    failed = F.col("failed_bits").bitwiseAND(F.lit(m))
    counts = rows.select(failed.alias("f")).groupBy("f").count()  # at most 2 ** rules rows
    rules = counts.sparkSession.createDataFrame([(r, BIT[r]) for r in POLICIES[policy]], "rule string, bit int")
    return rules.join(counts, F.col("f").bitwiseAND(F.col("bit")) != 0, "left").groupBy("rule").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("f") == F.col("bit"), F.col("count"))), F.lit(0)).alias("n_only"))


def filter_documents(docs: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """The documents whose ledger entry passes the policy, with their own columns. Row-local."""
    inner = docs.select(F.col(text).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return ledger(inner, "_text", "_row").filter(verdict(policy)).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the ledger of every document with the base verdict and the current policy's."""
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id", *MEASURES[:5], (~verdict("base")).alias("base_failed"), verdict("v1").alias("kept"), "failed_bits", "n_upper", "n_lines")


SQL = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select *, list_filter(string_split_regex(t, '{SPACE}'), lambda x: x <> '') as w,
             list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '{SPACE}', '', 'g')) > 0) as l from d),
g as (select *, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) as g from w),
u as (select doc_id, unnest(g) as x, unnest(range(len(g))) as i from g),
r as (select doc_id, i from (select *, count(*) over (partition by doc_id, x) as c from u) where c > 1),
c as (select doc_id, count(*) as n_repeat_words from (select distinct doc_id, i + k as p from r, range(3) as z(k)) group by 1),
m as (select g.doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '{SPACE}', '', 'g'))::bigint as word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
             (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
             len(regexp_extract_all(t, '\\p{{Lu}}'))::bigint as n_upper, len(l)::bigint as n_lines
      from g left join c using (doc_id)),
b as (select *, ({" | ".join(f"case when {rule} then {BIT[name]} else 0 end" for name, rule in RULES.items())})::integer as failed_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & {mask("base")} <> 0 as base_failed, failed_bits & {mask("v1")} = 0 as kept, failed_bits, n_upper, n_lines
from b
"""
