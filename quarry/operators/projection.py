"""SQL projection over a frame (the stored SELECT of a pipeline).

The stored SQL names its input as a view (``table`` by default).  A shared
view name is session-global, so parallel pipelines would collide; here each
call binds the frame under a run-unique name through ``spark.sql``'s own
``{placeholder}`` binding.  Stored text that says ``from table`` is rebound by
turning that one identifier into the placeholder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


_WORDS = "on using where group order having limit join inner left right full cross natural union except intersect window lateral tablesample sort cluster distribute qualify".split()


def _rebind(text: str, name: str, placeholder: str) -> str:
    """Turns references to the frame ``name`` after FROM, JOIN or a comma of a
    FROM list into the placeholder, with the name kept as alias when no
    other follows, so that ``name.column`` still means what it says."""
    ident = r"(`?)" + re.escape(name) + r"\2(?=[\s,);]|$)"
    alias = r"(?!\s+(?:as\s+)?(?!(?:" + "|".join(_WORDS) + r")\b)[A-Za-z_`])"
    first = re.compile(r"(?i)\b((?:from|join)\s+|(?<=[\s\w`}]),\s*(?=" + r"`?" + re.escape(name) + r"`?\s*(?:[,);]|$|\s(?:" + "|".join(_WORDS) + r")\b)))" + ident)
    out, at = [], 0
    for m in first.finditer(text):
        if m.group(1).lstrip().startswith(","):
            # A comma counts only within a FROM list, not in a SELECT list.
            before = re.sub(r"\([^()]*\)", "", text[:m.start()]).lower()
            if before.rfind("from") <= max(before.rfind(w) for w in ("select", "where", "group by", "order by", "having", " on ")):
                continue
        named = re.match(alias, text[m.end():], re.I) is not None
        out += [text[at:m.start()], m.group(1), "{" + placeholder + "}", f" as `{name}`" if named else ""]
        at = m.end()
    return "".join(out) + text[at:]


def _bind(sql: str, view: str) -> str:
    text = sql.strip().rstrip(";").strip()
    # Escape literal braces for the formatter, then mark the view reference.
    return _rebind(text.replace("{", "{{").replace("}", "}}"), view, "__input")


def sql_projection(df: DataFrame, sql: str, view: str = "table",
                   spark: SparkSession | None = None, **others: DataFrame) -> DataFrame:
    """Run ``sql`` with ``df`` bound to ``view``.  ``{name}``-style
    placeholders are also accepted (``{table}``), and ``others`` binds more
    frames by name."""
    spark = spark or df.sparkSession
    if "{" + view + "}" in sql:
        return spark.sql(sql.strip().rstrip(";"), **{view: df}, **others)
    return spark.sql(_bind(sql, view), __input=df, **others)


def named_projection(frames: dict[str, DataFrame], sql: str) -> DataFrame:
    """P5: a stored SELECT over one or more named frames (the descriptor's
    ``sql``)."""
    if not frames:
        raise ValueError("named_projection needs at least one frame")
    spark = next(iter(frames.values())).sparkSession
    text = sql.strip().rstrip(";").replace("{", "{{").replace("}", "}}")
    for name in frames:
        text = _rebind(text, name, name)
    return spark.sql(text, **frames)
