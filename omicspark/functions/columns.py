"""Column expressions: guarded numbers, lists, attribute maps, CIGAR and percent-encoded text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of a missing cell in reports and in sample sheets.
REPORT_MISSING = ("", "na", "nan", "none", "null")
SHEET_MISSING = ("", "-", ".", "na", "n/a", "null", "none")
#: Largest integer that a double keeps exactly.
EXACT_DOUBLE = 9007199254740992


def blank_to_null(c: Column, missing: tuple[str, ...] = REPORT_MISSING) -> Column:
    """Trimmed text, or null for a spelling of missing."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(*missing), t)


def ratio(numerator: Column, denominator: Column, scale: float = 100.0) -> Column:
    """``scale * numerator / denominator``; null where either is missing or the denominator is not positive."""
    return F.when(denominator > 0, F.lit(scale) * numerator / denominator)


def number(c: Column, kind: str = "double") -> Column:
    """Text as a finite number, or null."""
    n = F.expr("NULL") if c is None else c.try_cast(kind)
    return F.when(~F.isnan(n.cast("double")) & (F.abs(n.cast("double")) != float("inf")), n)


def sum_if_complete(value: Column) -> Column:
    """Sum of a group, null if any member is missing."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def gff_pairs(field: Column) -> Column:
    """Attribute column as an array of ``struct(k, v)``; the whole line is GTF (``k "v";``) if a quoted value follows a key, else GFF3 (``k=v;``)."""
    gff3 = F.contains(field, F.lit("=")) & ~field.rlike('\\w\\s+"')
    parts = F.transform(F.split(field, ";"), lambda p: F.trim(p))
    text = lambda k, v: F.struct(F.trim(k).alias("k"), F.trim(v).alias("v"))
    named = F.transform(F.filter(parts, lambda p: F.contains(p, F.lit("="))), lambda p: text(F.substring_index(p, "=", 1), F.substring(p, F.instr(p, "=") + 1, F.length(p))))
    form = r'^(\S+)\s+"?([^"]*)"?$'
    quoted = F.transform(F.filter(parts, lambda p: p.rlike(form)), lambda p: text(F.regexp_extract(p, form, 1), F.regexp_extract(p, form, 2)))
    return F.when(gff3, named).otherwise(quoted)


def gff_attributes(field: Column) -> Column:
    """Attribute column of GFF3 or GTF as a map, the last of repeated keys winning."""
    return last_wins_map(gff_pairs(field))


def last_pairs(pairs: Column) -> Column:
    """An array of ``struct(k, v)`` without entries whose key comes again after them; most arrays have none and stay as they are."""
    keys = lambda a: F.transform(a, lambda p: p["k"])
    last = lambda a: F.filter(a, lambda p, i: ~F.exists(F.slice(a, i + 2, F.size(a)), lambda q: q["k"] == p["k"]))
    pick = lambda a: F.when(F.size(F.array_distinct(keys(a))) == F.size(a), a).otherwise(last(a))
    return F.element_at(F.transform(F.array(pairs), pick), 1)  # the array is bound once, as the variable of an outer transform


def last_wins_map(pairs: Column) -> Column:
    """Map of an array of ``struct(k, v)`` in which later entries replace earlier ones."""
    return F.map_from_entries(last_pairs(pairs))


def percent_map(field: Column) -> Column:
    """``k=v;k=v`` with percent escapes as a map; a literal ``+`` stays, a bad escape gives null."""
    clean = F.replace(field, F.lit("+"), F.lit("%2B"))
    pairs = F.transform(
        F.filter(F.split(clean, ";"), lambda p: F.trim(p) != ""),
        lambda p: F.struct(
            F.try_url_decode(F.trim(F.substring_index(p, "=", 1))).alias("k"),
            F.try_url_decode(F.trim(F.regexp_replace(p, "^[^=]*=", ""))).alias("v"),
        ),
    )
    return last_wins_map(F.filter(pairs, lambda p: p["k"].isNotNull()))


def bar_list(field: Column) -> Column:
    """``a|b|c`` as an array without empty parts."""
    return F.filter(F.transform(F.split(F.coalesce(field, F.lit("")), r"\|"), lambda p: F.trim(p)), lambda p: p != "")


def cigar_ops(cigar: Column) -> Column:
    """CIGAR text as an array of ``struct(len, op)``."""
    return F.transform(
        F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1),
        lambda x: F.struct(F.substring(x, F.lit(1), F.length(x) - 1).cast("int").alias("len"), F.substring(x, -1, 1).alias("op")),
    )


def reference_steps(ops: Column, start: Column) -> Column:
    """Operations with the reference position and the place in the read (``seq_at``, from 0) at which each begins.

    One fold that takes both along: ``ops`` stands once in the expression, so a CIGAR is parsed once and not again for every operation.
    """
    moves = lambda o: F.when(o["op"].isin("M", "D", "N", "=", "X"), o["len"]).otherwise(0)
    reads = lambda o: F.when(o["op"].isin("M", "I", "S", "=", "X"), o["len"]).otherwise(0)
    none = F.array().cast("array<struct<op:string,len:int,pos:bigint,seq_at:int>>")
    begin = F.struct(start.cast("bigint").alias("pos"), F.lit(0).alias("seq_at"), none.alias("steps"))
    step = lambda a, o: F.struct(o["op"].alias("op"), o["len"].alias("len"), a["pos"].alias("pos"), a["seq_at"].alias("seq_at"))
    on = lambda a, o: F.struct((a["pos"] + moves(o)).alias("pos"), (a["seq_at"] + reads(o)).alias("seq_at"), F.concat(a["steps"], F.array(step(a, o))).alias("steps"))
    return F.aggregate(ops, begin, on, lambda a: a["steps"])


def flag_set(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) != 0
