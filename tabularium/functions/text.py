"""Text and number expressions. All are column expressions that stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2})?$"
EMAIL_SHAPE = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"


def clean_text(col: Column) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(col), F.lit(""))


def full_name(*parts: Column) -> Column:
    return F.concat_ws(" ", *[clean_text(p) for p in parts])


def collapse_spaces(col: Column) -> Column:
    return F.regexp_replace(F.trim(col), r"\s+", " ")


def normalize_city(col: Column) -> Column:
    return F.lower(collapse_spaces(col))


def title_words(col: Column) -> Column:
    return F.initcap(F.lower(collapse_spaces(col)))


def safe_int(col: Column) -> Column:
    """Integer value of a text; bad text, overflow and NULL give NULL."""
    return col.try_cast("int")


def add_tax(amount: Column, percent: Column) -> Column:
    """Amount with tax, rounded half away from zero at two digits."""
    rate = F.lit(1) + percent.cast("decimal(9,4)") / F.lit(100).cast("decimal(9,4)")
    return F.round(amount.cast("decimal(18,2)") * rate.cast("decimal(12,6)"), 2)


def pct_change(old: Column, new: Column) -> Column:
    """Change in percent at two digits; NULL when the old value is zero."""
    change = (F.lit(100) * (new - old)).cast("double")
    return F.round(change / F.nullif(old.cast("double"), F.lit(0.0)), 2)


def mask_email(col: Column) -> Column:
    """First character and the domain stay; a text without a name before an @ is left as it is."""
    hidden_name = F.concat(F.left(col, F.lit(1)), F.lit("***@"), F.substring_index(col, "@", -1))
    return F.when(F.instr(col, "@") > 1, hidden_name).otherwise(col)


def hidden(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def row_hash(*cols: Column, null_text: str | None = None) -> Column:
    """md5 over the text of the columns.

    Without `null_text` a NULL column leaves no trace, as `concat_ws` does; with it, NULLs
    get a text of their own and moved NULLs change the hash.
    """
    texts = [c.cast("string") for c in cols]
    if null_text is not None:
        texts = [F.coalesce(c, F.lit(null_text)) for c in texts]
    return F.md5(F.concat_ws("|", *texts))


def row_text(*cols: Column) -> Column:
    """A text that tells any two rows apart: every field with its length in front, `-` for NULL."""
    fields = [c.cast("string") for c in cols]
    return F.concat(*[F.coalesce(F.concat(F.length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields])
