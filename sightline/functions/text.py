"""Label and prompt text rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Remove all Unicode white space from both ends (plain ``trim`` removes only blanks)."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalize_label(label: Column) -> Column:
    """Lower-case, strip, then turn ``_`` into blanks - in that order, so ``_x`` keeps a blank.

    A missing label reads as the word "none".
    """
    text = F.coalesce(label.cast("string"), F.lit("None"))
    return F.replace(strip(F.lower(text)), F.lit("_"), F.lit(" "))


def fill_template(template: Column, category: Column) -> Column:
    """Put the lower-cased category into the ``{}`` of a prompt template."""
    return F.replace(template, F.lit("{}"), F.lower(category))
