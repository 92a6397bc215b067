"""Anonymisation: consistent tokens, coarse dates, removed and replaced values.

Tokens number the sorted distinct values of a column. All columns of a table
share one dictionary, whose ranges are cut at values that a hash picks, so its
numbering is lazy and no task sees all values. The wide table is shuffled once,
by a hash of its masked values, to meet the numbers of each combination of them;
AQE splits the partition of a frequent combination.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lexicon, text
from tidemark.operators.aggregates import distinct_values

#: Makes a token of a value's number.
Token = Callable[[Column], Column]

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number_sorted(values: DataFrame, column: str = "value", index: str = "index", within: str | None = None, ranges: int = 128) -> DataFrame:
    """Distinct values with their 1-based position in sorted order, counted by itself for each value of ``within``.

    ``ranges`` values, those with the least hashes, cut all values into ranges
    of similar size. The cuts follow from the set of values alone, so positions
    in a range and the sizes of the ranges before it agree whenever they are
    computed, and nothing has to be stored. Of a group at most ``ranges`` sizes
    are ever summed up in one task.
    """
    group = F.lit(0) if within is None else F.col(within)
    # Of a long value its beginning is a cut as good.
    cut = F.struct(group.alias("g"), F.substring(column, 1, 64).alias("v"))
    picked = values.orderBy(F.xxhash64(group, column), *values.columns).limit(ranges).select(cut.alias("cut"))
    cuts = picked.agg(F.array_sort(F.collect_list("cut"))).scalar()
    own = F.struct(group.alias("g"), F.col(column).alias("v"))
    placed = values.withColumns({"__cuts": cuts, "__group": group, "__own": own})
    placed = placed.withColumn("__range", F.size(F.filter("__cuts", lambda c: c < F.col("__own")))).drop("__cuts", "__own")
    inside = Window.partitionBy("__group", "__range").orderBy(column)
    before = Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__group", "__range").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__group", "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    numbered = placed.withColumn("__at", F.row_number().over(inside)).join(offsets, ["__group", "__range"])
    return numbered.select(*values.columns, (F.col("__offset") + F.col("__at")).alias(index))


def token_dictionary(df: DataFrame, column: str, token: Token) -> DataFrame:
    """(value, token) of a column."""
    return number_sorted(distinct_values(df, column)).select("value", token(F.col("index")).alias("token"))


def prefix_token(prefix: str) -> Token:
    return lambda number: F.format_string(f"{prefix} %03d", number)


def email_token() -> Token:
    return lambda number: F.format_string(lexicon.EMAIL_TOKEN_FORMAT, number)


def url_token(slug: str) -> Token:
    return lambda number: F.format_string(f"{lexicon.URL_TOKEN_ROOT}{slug}/%03d", number)


@dataclass(frozen=True)
class Tokens:
    """How a column's values become tokens, made of their numbers; ``keep`` values stay, ``only`` says whether the column is masked at all."""

    token: Token
    keep: tuple[str, ...] = ()
    only: Column | None = None


def _join_spread(cells: DataFrame, dictionary: DataFrame, counted: DataFrame, pieces: int = 64) -> DataFrame:
    """Cells with their numbers; the cells of a frequent value meet ``pieces`` copies of its entry.

    Frequent is a value that a thousandth of all cells have, so there are a
    thousand of them at most, and no task gets all cells of a value that every row has.
    """
    often = F.col("__n") * 1000 >= counted.agg(F.sum("__n")).scalar()
    frequent = counted.where(often).select("at", "value", F.lit(True).alias("__often"))
    piece = F.when(F.col("__often"), F.pmod("__h", F.lit(pieces)).cast("int")).otherwise(0)
    spread = cells.join(F.broadcast(frequent), ["at", "value"], "left").withColumn("__piece", piece).drop("__often")
    copies = F.when(often, F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))
    entries = dictionary.select("at", "value", "index", F.explode(copies).alias("__piece"))
    return spread.join(entries, ["at", "value", "__piece"])


def tokenize_columns(df: DataFrame, rules: Mapping[str, Tokens]) -> DataFrame:
    """Replace the values of several columns by tokens; NULL and blank become NULL.

    The tokens of a row depend on its masked values alone. So the distinct
    combinations of them, which are narrow, get the numbers of their values from
    one dictionary of all columns, the cells of a frequent value in several pieces,
    and the table meets them once, by two hashes of the combination.
    """
    if not rules:
        return df
    columns = list(rules)
    shown = {c: text.as_text(c) for c in columns}

    def masked(c: str) -> Column:
        value, rule = shown[c], rules[c]
        wanted = ~text.is_blank(value)
        wanted = wanted & ~value.isin(list(rule.keep)) if rule.keep else wanted
        wanted = wanted & rule.only if rule.only is not None else wanted
        return F.coalesce(F.when(wanted, value), F.lit(""))

    values = {f"__v{i}": masked(c) for i, c in enumerate(columns)}
    hashes = {"__h": F.xxhash64(*values), "__k": F.xxhash64(F.lit(1), *values)}
    combinations = df.select(*[v.alias(n) for n, v in values.items()]).distinct().withColumns(hashes)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.col(n).alias("value")) for i, n in enumerate(values)])).alias("cell")
    cells = combinations.select("__h", "__k", cells).select("__h", "__k", "cell.*").where(F.col("value") != "")
    counted = cells.groupBy("at", "value").agg(F.count(F.lit(1)).alias("__n"))
    dictionary = number_sorted(counted, within="at")
    numbers = [F.max(F.when(F.col("at") == i, F.col("index"))).alias(f"__i{i}") for i in range(len(columns))]
    # The cells of a combination lie in other partitions, so an aggregate before the shuffle would only fill its map.
    met = _join_spread(cells, dictionary, counted).select("__h", "__k", "at", "index").repartition("__h", "__k")
    numbered = met.groupBy("__h", "__k").agg(*numbers)
    joined = df.withColumns(values).withColumns(hashes).join(numbered, ["__h", "__k"], "left")

    def final(c: str) -> Column:
        rule, number = rules[c], F.col(f"__i{columns.index(c)}")
        found = F.when(number.isNotNull(), rule.token(number))
        if rule.keep:
            found = F.when(shown[c].isin(list(rule.keep)), shown[c]).otherwise(found)
        return found if rule.only is None else F.when(rule.only, found).otherwise(F.col(f"`{c}`"))

    return joined.select(*[final(c).alias(c) if c in rules else F.col(f"`{c}`") for c in df.columns])


def mask_names(df: DataFrame, column: str, prefix: str = lexicon.PERSON_PREFIX) -> DataFrame:
    return tokenize_columns(df, {column: Tokens(prefix_token(prefix))})


def mask_emails(df: DataFrame, column: str) -> DataFrame:
    return tokenize_columns(df, {column: Tokens(email_token())})


def mask_urls(df: DataFrame, column: str, slug: str, keep: Sequence[str] = ()) -> DataFrame:
    return tokenize_columns(df, {column: Tokens(url_token(slug), tuple(keep))})


def month_floor(c: Column | str) -> Column:
    """First moment of the month, zone-free."""
    return F.trunc(text.col(c).cast("date"), "month").cast("timestamp_ntz")


def coarsen_dates(df: DataFrame) -> DataFrame:
    """Dates and timestamps to their month's start.

    Text columns whose name hints at a date are coarsened too, if any of their
    values parses; that one question is answered for all such columns by a
    single aggregate.
    """
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    typed = [f.name for f in df.schema.fields if isinstance(f.dataType, temporal)]
    hinted = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and any(h in f.name.lower() for h in lexicon.DATE_NAME_HINTS)
    ]
    changes = {name: month_floor(name) for name in typed}
    if hinted:
        from tidemark.functions.dates import parse_mixed

        parsed = {name: parse_mixed(text.strip_text(name)) for name in hinted}
        found = df.agg(*[F.count(p).alias(name) for name, p in parsed.items()]).first()
        changes |= {name: month_floor(parsed[name]) for name in hinted if found[name] > 0}
    return df.withColumns(changes) if changes else df


def null_out(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.lit(None).cast("string") for name in columns if name in df.columns})


def replace_text(df: DataFrame, texts: Mapping[str, str]) -> DataFrame:
    """Every non-null value by a fixed text; NULL stays NULL."""
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.lit(t)) for c, t in texts.items() if c in df.columns})


def textual_flags(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row with a flag per text column: False where every value is a number.

    A number is digits with sign, point and exponent at most, so that no name or
    code such as ``10d`` passes as one; ``NaN`` and ``Infinity`` are texts.
    Columns without any value count as textual. One pass over all columns.
    """
    number = lambda n: F.when(F.col(n).isNotNull(), F.col(n).rlike(_NUMBER))
    return df.agg(*[F.coalesce(~F.bool_and(number(n)), F.lit(True)).alias(n) for n in names])


def textual_columns(df: DataFrame) -> DataFrame:
    """(column_name, is_textual) of the string columns, from ``textual_flags``."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, is_textual boolean")
    return textual_flags(df, names).unpivot([], names, "column_name", "is_textual")


def rebuild_full_name(first: str, last: str) -> Column:
    joined = F.concat(
        F.coalesce(text.strip_text(first), F.lit("")), F.lit(" "), F.coalesce(text.strip_text(last), F.lit(""))
    )
    return F.nullif(text.strip_text(joined), F.lit(""))


def is_person_column(name: str) -> bool:
    if name in lexicon.PERSON_COLUMNS:
        return True
    return name.endswith(lexicon.PERSON_SUFFIX) and not any(word in name for word in lexicon.PERSON_EXCLUSIONS)


def masking_rule(name: str, url_words: Sequence[str] = lexicon.URL_WORDS) -> tuple[str, Token | str | None] | None:
    """Which treatment a text column gets, decided by its name alone; ``url_words`` mark columns with links."""
    lowered = name.lower()

    def has(words: Sequence[str]) -> bool:
        return any(word in lowered for word in words)

    if is_person_column(lowered):
        return "token", prefix_token(lexicon.PERSON_PREFIX)
    if has(lexicon.ORGANIZATION_WORDS):
        return "token", prefix_token(lexicon.ORGANIZATION_PREFIX)
    if has(lexicon.ROLE_WORDS):
        return "token", prefix_token(lexicon.ROLE_PREFIX)
    if "location" in lowered:
        return "token", prefix_token(lexicon.LOCATION_PREFIX)
    if lowered in lexicon.REPLACED_TEXTS:
        return "text", lexicon.REPLACED_TEXTS[lowered]
    if has(url_words):
        return "url", lowered.replace("_", "-")
    return None


def sanitize(df: DataFrame, kept_urls: Sequence[str] = (), url_words: Sequence[str] = lexicon.URL_WORDS) -> DataFrame:
    """Anonymised copy of any table, by column-name rules.

    A text column that holds nothing but numbers is left as it is; which ones do
    is an aggregate inside the plan. All token columns share one dictionary.
    """
    out = coarsen_dates(df)
    strings = [f.name for f in out.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = {"email_address", *lexicon.NULLED_COLUMNS, *lexicon.KEPT_URL_COLUMNS}
    ruled = {n: rule for n in strings if n.lower() not in fixed and (rule := masking_rule(n, url_words)) is not None}
    flags = textual_flags(out, list(ruled)).select(F.struct("*")).scalar() if ruled else None
    tokens: dict[str, Tokens] = {}
    changes: dict[str, Column] = {}
    for name in out.columns:
        lowered = name.lower()
        if lowered == "email_address":
            tokens[name] = Tokens(email_token())
        elif lowered in lexicon.NULLED_COLUMNS:
            changes[name] = F.lit(None).cast("string")
        elif lowered in lexicon.KEPT_URL_COLUMNS:
            changes[name] = text.strip_text(name)
        elif name in ruled:
            kind, argument = ruled[name]
            only = flags.getField(name)
            if kind == "token":
                tokens[name] = Tokens(argument, only=only)
            elif kind == "text":
                changes[name] = F.when(only & F.col(name).isNotNull(), F.lit(argument)).otherwise(F.col(name))
            else:
                tokens[name] = Tokens(url_token(argument), tuple(kept_urls), only)
    # fixed texts go in before the shuffle, so that nothing long is carried for them
    out = tokenize_columns(out.withColumns(changes) if changes else out, tokens)
    if {"first_name", "last_name", "full_name"} <= set(out.columns):
        out = out.withColumn("full_name", rebuild_full_name("first_name", "last_name"))
    return out
