"""Column expressions that clean and type raw values."""

from __future__ import annotations

from itertools import chain
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# yes/no codes of the extracts.
YES = ("Oui", "O", "Positif", "+", "P")
NO = ("Non", "N", "Négatif", "-")

# Fixed value: the anchored e-mail pattern.
EMAIL_PATTERN = r"(^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$)"

# Tokens a CSV field may hold for a missing value.
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# Age limit, exclusive on both ends.
AGE_BOUNDS = (0, 120)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yes_no(c: str | Column) -> Column:
    """Three-valued flag; unknown codes are null."""
    c = col(c)
    return F.when(c.isin(*YES), True).when(c.isin(*NO), False)


def clean_age(c: str | Column) -> Column:
    low, high = AGE_BOUNDS
    years = col(c).try_cast("double")
    return F.when((years > low) & (years < high), years.cast("bigint"))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(col(c), F.lit(" "))


def sentinel_to_null(c: str | Column, sentinels: Sequence[str] = ("", "None")) -> Column:
    c = col(c)
    return F.when(~c.isin(*sentinels), c)


def to_nullable_int(c: str | Column) -> Column:
    return sentinel_to_null(col(c).cast("string")).cast("bigint")


def csv_null(name: str) -> Column:
    """Column of a CSV file with the missing-value tokens as null."""
    tokens = ", ".join(f"'{t}'" for t in CSV_NULL_TOKENS)
    return F.expr(f"CASE WHEN `{name}` NOT IN ({tokens}) THEN `{name}` END")


def plain_number(c: str | Column) -> Column:
    """Decimal comma to point, blanks between thousands removed."""
    return F.translate(col(c), ",  ", ".")


def decimal_comma(c: str | Column) -> Column:
    return F.nanvl(plain_number(c).try_cast("double"), F.lit(None))


def whole_number(c: str | Column) -> Column:
    """Integer, also when written with decimals."""
    digits = plain_number(c)
    return F.coalesce(digits.try_cast("bigint"), digits.try_cast("decimal(38,6)").cast("bigint"))


def strict_date(c: str | Column) -> Column:
    """Day/month/year with or without leading zeros; a malformed date raises."""
    return F.to_timestamp_ntz(col(c), F.lit("d/M/yyyy"))


def tolerant_date(c: str | Column) -> Column:
    return F.try_to_timestamp(col(c), F.lit("d/M/yyyy")).cast("timestamp_ntz")


def one_hot_flags(source: str, names: Mapping[str, str | None], strict: bool = True) -> dict[str, Column]:
    """One non-null flag per named value of the source column.

    `names` maps value to new column; a value mapped to None is known but not kept.
    Strict mode raises on any value outside the mapping, nulls included; one blank is
    always accepted.
    """
    c = F.col(f"`{source}`")
    value = c
    if strict:
        message = F.concat(F.lit(f"{source}: unlisted value "), F.coalesce(c, F.lit("null")))
        value = F.when(c.isin(*names, " "), c).otherwise(F.raise_error(message))
    return {new: F.coalesce(value == v, F.lit(False)) for v, new in names.items() if new}


def one_hot(df: DataFrame, source: str, names: Mapping[str, str | None], strict: bool = True) -> DataFrame:
    """Replace a column by the flags of its values; a flag may take over its name."""
    others = [F.col(f"`{n}`") for n in df.columns if n.lower() != source.lower()]
    return df.select(*others, *[flag.alias(new) for new, flag in one_hot_flags(source, names, strict).items()])


def month_index(c: str | Column) -> Column:
    """Calendar months since year 0, so that differences are whole months."""
    c = col(c)
    return F.year(c) * 12 + F.month(c)


def month_distance(a: str | Column, b: str | Column) -> Column:
    return F.abs(month_index(a) - month_index(b))


def age_years(at: str | Column, birth: str | Column) -> Column:
    return F.datediff(col(at), col(birth)) / F.lit(365.25)


def label_of(c: str | Column, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Code to label by lookup, `default` for anything else."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    found = table[col(c)]
    return found if default is None else F.coalesce(found, F.lit(default))


def flag_in(columns: Sequence[str], codes: Sequence[str], label: str, other: str = "Non") -> Column:
    """`label` when any of the columns holds one of the codes."""
    hit = F.lit(False)
    for name in columns:
        hit = hit | F.coalesce(F.col(name).isin(*codes), F.lit(False))
    return F.when(hit, label).otherwise(other)


def receptor_label(evaluated: str | Column, receptor: str | Column) -> Column:
    """Hormone receptor result: only an evaluated sample has one."""
    done, result = col(evaluated) == "O", col(receptor)
    return F.when(done & (result == "+"), "Positif").when(done & (result == "-"), "Négatif")


def compact_date(c: str | Column) -> Column:
    return F.date_format(F.to_date(col(c), "dd/MM/yy"), "ddMMyy")


def study_label(number: str | Column, compact: str | Column) -> Column:
    return F.concat_ws("_", col(number).cast("string"), col(compact))


def acr_level(c: str | Column) -> Column:
    """Numeric text to level; missing or unreadable is 0."""
    c = col(c)
    return F.coalesce(F.when(c.rlike("^[0-9]+$"), c.cast("int")), F.lit(0))


def reader_result(right: str | Column, left: str | Column) -> Column:
    """`positive` unless both sides are readable and at level 1 or 2."""

    def suspect(c: str | Column) -> Column:
        level = acr_level(c)
        return (level == 0) | (level > 2)

    return F.when(suspect(right) | suspect(left), "positive").otherwise("negative")


def highest_acr(*columns: str | Column) -> Column:
    return F.greatest(*[acr_level(c) for c in columns])


def valid_email(c: str | Column) -> Column:
    c = col(c)
    return F.when(c.rlike(EMAIL_PATTERN), c)


def strip_time(c: str | Column) -> Column:
    return F.to_date(col(c))


def long_link(*ids: str | Column) -> Column:
    """True if any identifier is longer than 10 characters; null when that is unknown."""
    checks = [F.length(col(c)) > 10 for c in ids]
    out = checks[0]
    for check in checks[1:]:
        out = out | check
    return out


def presence(c: str | Column) -> Column:
    return F.when(col(c).isNotNull(), "Some").otherwise("-")


def zero_padded(c: Column, width: int) -> Column:
    """Left-padded digits; a number that is already longer is kept whole."""
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def day_of_year(c: str | Column) -> Column:
    return F.date_format(col(c), "DDD")
