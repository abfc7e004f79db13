"""Query texts from a table of templates (B18), filled from the fields of each row.

A template is text with placeholders: ``{name}`` has to be filled, or the template is not issued for the row; a part in
brackets, ``[PCN {pcn} ]``, falls away where one of its fields is missing.  Null and '' count as missing, as does a name
that no field has.  ``needs`` is the least number of bracketed parts that have to stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_TEMPLATES = 1_000


def _joined(parts: Column) -> Column:
    """The texts one after the other; null if one is null."""
    return F.aggregate(parts, F.lit(""), lambda done, x: F.concat(done, x))


def _filled(text: Column, values: Column) -> Column:
    parts = F.split(text, r"(?=\{)|(?<=\})", -1)
    return _joined(F.transform(parts, lambda p: F.when(p.rlike(r"^\{[^{}]*\}$"), F.try_element_at(values, F.substring(p, F.lit(2), F.length(p) - 2))).otherwise(p)))


def fill(template, fields: dict[str, Column | str], needs=0) -> Column:
    """The text of ``template`` for the row's ``fields``; null where it is not to be issued."""
    t = F.col(template) if isinstance(template, str) else template
    cols = {k: (F.col(c) if isinstance(c, str) else c).cast("string") for k, c in fields.items()}
    values = F.create_map(*[x for k, c in cols.items() for x in (F.lit(k), F.nullif(c, F.lit("")))])
    parts = F.split(t, r"(?=\[)|(?<=\])", -1)
    is_optional = lambda p: p.rlike(r"^\[.*\]$")
    inner = lambda p: F.substring(p, F.lit(2), F.length(p) - 2)
    done = F.transform(parts, lambda p: F.struct(
        F.when(is_optional(p), F.coalesce(_filled(inner(p), values), F.lit(""))).otherwise(_filled(p, values)).alias("text"),
        (is_optional(p) & _filled(inner(p), values).isNotNull()).alias("stays")))
    stay = F.size(F.filter(done, lambda x: x["stays"]))
    return F.when(stay >= needs, _joined(F.transform(done, lambda x: x["text"])))


def issue(keys: DataFrame, fields: dict[str, Column | str], templates: DataFrame) -> DataFrame:
    """``keys`` with ``priority`` and ``query`` for each template that can be filled.

    ``templates``: (priority, template, needs), a caller's table of MOST_TEMPLATES rows at most.  It becomes an array
    of literals, so each key's queries are made in its own row, without a join."""
    rows = templates.select("priority", "template", "needs").limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    kind = "array<struct<priority:int,query:string>>"
    texts = [F.struct(F.lit(r["priority"]).cast("int").alias("priority"), fill(F.lit(r["template"]), fields, r["needs"]).alias("query")) for r in rows]
    made = F.filter(F.array(*texts), lambda x: x["query"].isNotNull()) if texts else F.array().cast(kind)
    # the generator stands alone: no condition on its output is inferred below it
    return keys.withColumn("_made", F.explode_outer(made)).select(*keys.columns, "_made.priority", "_made.query").where(F.col("query").isNotNull())
