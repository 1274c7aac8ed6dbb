"""Column expressions and DataFrame helpers (all JVM-side built-ins)."""

from cinerank.functions.columns import (  # noqa: F401
    cosine, dot, l2_norm, log10_at_least_one, register_sql_functions, round6,
    yearmonth,
)
from cinerank.functions.ranking import explode_recs, nest_recs, rank_within, ranked_pairs, top_n  # noqa: F401
