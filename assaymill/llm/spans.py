"""Positions of pattern matches in whole texts, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 256
SPAN = "array<struct<start:int,stop:int,value:string>>"


def with_matches(df: DataFrame, name: str, pattern: str, guard: Column | None = None) -> DataFrame:
    """Adds ``name``: start, stop (code points, end exclusive) and value of each match of ``pattern`` in ``text``.

    The pieces between the matches give the starts. ``guard``: a cheap test that holds
    wherever the pattern matches. Patterns must have no empty match.
    """
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    values = F.when(guard, found).otherwise(F.array().cast("array<string>")) if guard is not None else found
    df = df.withColumn("_values", values)
    df = df.withColumn("_pieces", F.when(F.size("_values") > 0, F.split("text", pattern, -1)))
    # Appending copies an array, so matches are gathered in blocks and the blocks in a list.
    block = f"""aggregate(sequence(b * {BLOCK}, least(size(_values), (b + 1) * {BLOCK}) - 1),
            named_struct('at', whole.at, 'list', cast(array() as {SPAN})),
            (acc, i) -> named_struct(
                'at', acc.at + char_length(_pieces[i]) + char_length(_values[i]),
                'list', concat(acc.list, array(named_struct(
                    'start', acc.at + char_length(_pieces[i]),
                    'stop', acc.at + char_length(_pieces[i]) + char_length(_values[i]),
                    'value', _values[i])))))"""
    starts = F.expr(
        f"""flatten(aggregate(sequence(0, (size(_values) - 1) div {BLOCK}),
                named_struct('at', 0, 'lists', cast(array() as array<{SPAN}>)),
                (whole, n) -> transform(array(cast(n as int)), b -> transform(array({block}),
                    x -> named_struct('at', x.at, 'lists', concat(whole.lists, array(x.list))))[0])[0],
                whole -> whole.lists))"""
    )
    empty = F.expr(f"cast(array() as {SPAN})")
    return df.withColumn(name, F.when(F.size("_values") > 0, starts).otherwise(empty)).drop("_values", "_pieces")


def joined(kinds: list[str], columns: list[str]) -> Column:
    """All spans of ``columns`` as kind:start:end by start, then kind as listed, comma-joined."""
    parts = [
        f"transform({column}, x -> struct(x.start, {n} as kind, x.stop, concat_ws(':', '{kind}', x.start, x.stop) as shown))"
        for n, (kind, column) in enumerate(zip(kinds, columns))
    ]
    return F.expr(f"array_join(transform(array_sort(concat({', '.join(parts)})), x -> x.shown), ',')")
