"""Rule tables with wildcards, as bitsets over the values of categorical columns.

Bit i of a value's bitset is set where rule i fits it. A row fits the rules whose bits are set in the bitsets of all its
values: their conjunction, of which the highest bit is the last rule. So rules are held against each column's vocabulary once,
and never against tuples of values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64


def quoted(name: str) -> str:
    """A column name that Spark takes as one name."""
    return "`" + name.replace("`", "``") + "`"


def matches(pattern: Column, value: Column) -> Column:
    """Whether value fits pattern, in which * stands for any characters; a null pattern fits all."""
    pieces = F.concat(F.lit("^\\Q"), F.replace(pattern, F.lit("*"), F.lit("\\E.*\\Q")), F.lit("\\E$"))
    return pattern.isNull() | F.regexp_like(value, pieces)


def _bitsets(fits: DataFrame, words: int) -> DataFrame:
    """(code, bits) of fits(code, word, part), of which the parts of a word are joined by or."""
    joined = fits.groupBy("code", "word").agg(F.bit_or("part").alias("part")).groupBy("code").agg(F.map_from_entries(F.collect_list(F.struct("word", "part"))).alias("parts"))
    zero = F.lit(0).cast("long")
    return joined.select("code", F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.coalesce(F.try_element_at("parts", w), zero)).alias("bits"))


def _parts(rules: DataFrame, column: str) -> DataFrame:
    """(column, word, part): the rules of each pattern or code of a column as words of bits."""
    bit = F.expr(f"shiftleft(1L, CAST(rule_i % {BITS} AS INT))")
    return rules.groupBy(F.col(quoted(column)).alias("wanted"), F.expr(f"CAST(rule_i div {BITS} AS INT)").alias("word")).agg(F.bit_or(bit).alias("part"))


def _words(rules: DataFrame) -> int:
    """Words that hold a bit for each rule; rules are numbered from 0."""
    low, high = rules.agg(F.min("rule_i"), F.max("rule_i")).first()
    if low is not None and low < 0:
        raise ValueError("rules are numbered from 0")
    return (high or 0) // BITS + 1


def pattern_sets(rules: DataFrame, values: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """For each column of values a table (code, bits): the rules whose pattern fits the code's value.

    rules has rule_i and, for each column, a pattern; values[c] has (code, value). Patterns without a * meet their values by
    equality; only the distinct others are tried on all values of a column.
    """
    words = _words(rules)
    out = {}
    for column, known in values.items():
        parts = _parts(rules, column)
        exact = F.coalesce(~F.contains("wanted", F.lit("*")), F.lit(False))
        equal = known.join(parts.where(exact), F.col("value") == F.col("wanted")).select("code", "word", "part")
        tried = parts.where(~exact).select("wanted").distinct()
        fitting = known.join(tried, matches(F.col("wanted"), F.col("value"))).select("code", F.col("wanted").alias("fits"))
        loose = fitting.join(parts.where(~exact), F.col("fits").eqNullSafe(F.col("wanted"))).select("code", "word", "part")
        out[column] = _bitsets(equal.unionByName(loose), words)
    return out


def code_sets(rules: DataFrame, df: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """The same for rules that have codes, where -1 fits all: for each code of df's columns, a null one included."""
    words = _words(rules)
    out = {}
    for column in columns:
        parts, known = _parts(rules, column), df.select(F.col(quoted(column)).alias("code")).distinct()
        fits = known.join(parts, (F.col("code") == F.col("wanted")) | (F.col("wanted") == -1))
        out[column] = _bitsets(fits.select("code", "word", "part"), words)
    return out


def with_bits(df: DataFrame, sets: dict[str, DataFrame], columns: dict[str, str], into: str = "__bits") -> DataFrame:
    """df with the bitset of the rules that fit all its columns, or null; columns maps rule columns to those of df. A code without a set fits no rule."""
    if missing := set(columns.values()) - set(df.columns):
        raise ValueError(f"missing columns: {sorted(missing)}")
    out, names = df, []
    for k, (rule, column) in enumerate(columns.items()):
        side = sets[rule].select(F.col("code").alias(f"__code{k}"), F.col("bits").alias(f"__bits{k}"))
        names.append(f"__bits{k}")
        out = out.join(side, F.col(quoted(column)).eqNullSafe(F.col(f"__code{k}")), "left")
    both = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)), map(F.col, names))
    return out.withColumn(into, both).select(*[F.col(quoted(c)) for c in df.columns], into)


def fits_any(bits: Column) -> Column:
    return F.coalesce(F.exists(bits, lambda word: word != 0), F.lit(False))


def last_bit(bits: Column) -> Column:
    """Number of the highest bit, or null."""
    return F.array_max(F.transform(bits, lambda word, k: F.when(word != 0, k * BITS + F.length(F.bin(word)) - 1)))


def allow_rules(df: DataFrame, sets: dict[str, DataFrame], columns: dict[str, str]) -> DataFrame:
    """Rows that a rule covers. A null code is not covered."""
    return with_bits(df, sets, columns).where(fits_any(F.col("__bits"))).drop("__bits")


def last_rules(df: DataFrame, sets: dict[str, DataFrame], columns: dict[str, str]) -> DataFrame:
    """The distinct tuples of df's columns that a rule covers, with rule_i of the last one."""
    tuples = df.select(*[F.col(quoted(c)) for c in columns.values()]).distinct()
    return with_bits(tuples, sets, columns).withColumn("rule_i", last_bit(F.col("__bits"))).where("rule_i IS NOT NULL").drop("__bits")


def deny_uncovered(df: DataFrame, uncovered: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose codes are not in uncovered; a null or unknown code stays."""
    return df.join(uncovered, columns, "left_anti")


def classify_last_match(pathways: DataFrame, rules: DataFrame, columns: list[str]) -> DataFrame:
    """pathways with rule_i of the last rule whose every code equals the row's or is -1; none raises an error."""
    found = with_bits(pathways, code_sets(rules, pathways, columns), {c: c for c in columns})
    best = last_bit(F.col("__bits"))
    return found.withColumn("rule_i", F.when(best.isNotNull(), best).otherwise(F.raise_error(F.lit("a pathway is covered by no rule")).cast("int"))).drop("__bits")
