"""Fill-in-middle transformation by one regular expression per row, in DataFrame functions.

Texts are cut into units, lines with their line end. ``regexp_count`` gives their number n;
two numbers of the row's digest say after how many units the prefix and the middle end, a
and b. The row's own pattern then counts them with possessive groups, ``(unit{a}+)`` and
``(unit{b-a}+)``, and takes the rest as suffix, so that a single match finds and reorders
all three parts. Possessive groups never go back, so a text is read once, however long.

The sentinels must not overlap: each starts with a character that stands nowhere else in
them. Then a text without sentinels can be rebuilt from its output, exactly.

Null text counts as empty; empty texts, and texts that hold a sentinel, stay plain, with
null for the lengths. A null id counts as the empty text in the digest. Rows that share an
id are cut by the same digest; each gets a row. An empty table gives no rows. Other columns
are not read, whatever their names are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busgrid.llm.common import table

UNIT = r"[^\n]*\n|[^\n]+"
#: The same units; a run of a line's characters is never given back.
_UNIT = r"(?:[^\n]*+\n|[^\n]++)"
SENTINELS = ("<P>", "<S>", "<M>")
SEED = 7
RATE, SPM_RATE = 100, 50


def _check(sentinels) -> None:
    firsts = {s[0] for s in sentinels if s}
    if len(set(sentinels)) < 3 or not all(sentinels) or any(c in s[1:] for s in sentinels for c in firsts):
        raise ValueError("sentinels overlap: their first characters must stand nowhere else")


def _numbers(doc_id: Column, seed: int) -> list[Column]:
    """The first four 32-bit numbers of the digest of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _replacement(*parts: str) -> str:
    """Sentinels as they are, and references to groups, for a replacement."""
    return "".join(p if re.fullmatch(r"\$\d", p) else re.sub(r"([\\$])", r"\\\1", p) for p in parts)


def transform(
    documents: DataFrame,
    sentinels: tuple[str, str, str] = SENTINELS,
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of each document.

    ``rate`` percent of the documents are reordered, ``spm_rate`` percent of those with the
    suffix first. Sentinels stand before prefix, suffix and middle.
    """
    _check(sentinels)
    p, s, m = sentinels
    h1, h2, h3, h4 = _numbers(F.col("doc_id"), seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    held = F.lit(False)
    for sentinel in sentinels:
        held = held | F.col("text").contains(sentinel)
    plain = (F.col("text") == "") | held | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm")
    cut = (
        documents.select("doc_id", text.alias("text"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
        .withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
        .withColumn("form", form)
        .withColumn("a", F.least(F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)))
        .withColumn("b", F.greatest(F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)))
    )
    pattern = F.format_string(
        rf"(?s)\A(%s{{%d}}+)(%s{{%d}}+)(.*+)\z",  # noqa: F541
        F.lit(_UNIT), F.col("a"), F.lit(_UNIT), F.col("b") - F.col("a"),
    )
    order = F.when(F.col("form") == "spm", _replacement(s, "$3", p, "$1", m, "$2")).otherwise(
        _replacement(p, "$1", s, "$3", m, "$2")
    )
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(
        F.regexp_replace("text", pattern, order)
    )
    at = {c: F.locate(c, F.col("output")) for c in sentinels}
    prefix = F.when(F.col("form") == "psm", at[s] - 1 - len(p)).when(
        F.col("form") == "spm", at[m] - at[p] - len(p)
    )
    middle = F.when(F.col("form") != "plain", F.length("output") + 1 - at[m] - len(m))
    return cut.withColumn("output", output).select(
        "doc_id",
        "n",
        "form",
        prefix.cast("long").alias("prefix_chars"),
        middle.cast("long").alias("middle_chars"),
        "output",
    )


def restored(form: Column, output: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` was made from."""
    p, s, m = (rf"\Q{x}\E" for x in sentinels)
    return (
        F.when(form == "psm", F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z", "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z", "$2$3$1"))
        .otherwise(output)
    )


def op12_fill_in_middle(spark, sf_dir):
    made = transform(table(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )


OP12_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
    sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents),
k as (
  select doc_id, text, units, len(units)::bigint as n,
    ('0x' || h[1:8])::bigint % (len(units) + 1) as x,
    ('0x' || h[9:16])::bigint % (len(units) + 1) as y,
    case when text = '' or text like '%<P>%' or text like '%<S>%' or text like '%<M>%'
           or ('0x' || h[17:24])::bigint % 100 >= 100 then 'plain'
         when ('0x' || h[25:32])::bigint % 100 < 50 then 'spm' else 'psm' end as form
  from d),
p as (
  select doc_id, text, n, form,
    coalesce(array_to_string(units[1:least(x, y)], ''), '') as prefix,
    coalesce(array_to_string(units[least(x, y) + 1:greatest(x, y)], ''), '') as middle,
    coalesce(array_to_string(units[greatest(x, y) + 1:], ''), '') as suffix
  from k)
select doc_id, n, form,
  case when form <> 'plain' then length(prefix)::bigint end as prefix_chars,
  case when form <> 'plain' then length(middle)::bigint end as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from p
"""
