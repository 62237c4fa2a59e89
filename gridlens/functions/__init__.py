"""Column-expression helpers.

Where a helper's logic has to be checked against the DuckDB oracle, it is
written once as SQL text over plain column names (``*_sql``) and used in
Spark through ``F.expr`` — both engines then evaluate the same expression.
"""

from gridlens.functions.exprs import (  # noqa: F401
    r6, rk, r6_sql, rk_sql, safe_div, epoch_s, epoch_s_sql, wrap_deg, angle_diff,
    wrap_deg_sql, angle_diff_sql, clip, severity_class, severity_class_sql,
)
from gridlens.functions.draws import (  # noqa: F401
    keyed_uniform, keyed_uniform_sql, normal_from, expo_from, weighted_choice_sql,
)
