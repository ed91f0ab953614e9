"""String helpers for manifest paths, as JVM expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col

MAX_LEN = 2147483647


def strip_prefix(col, prefix: str) -> Column:
    """Drop a literal prefix when present, else keep the value."""
    c = as_col(col)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, MAX_LEN)).otherwise(c)


def normalise_path(root, rel) -> Column:
    """``root / rel`` with leading slashes of ``rel`` removed and ``.``, ``..``, empty parts collapsed."""
    r, p = as_col(root), as_col(rel)
    joined = F.concat_ws("/", r, F.regexp_replace(p, "^/+", ""))
    parts = F.filter(F.split(joined, "/"), lambda t: (t != "") & (t != "."))
    resolved = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, t: F.when(t == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
            F.concat(acc, F.array(t))
        ),
    )
    lead = F.when(r.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(lead, F.array_join(resolved, "/"))
