"""Column functions over scores, names, weights and dimension columns."""

from guardlake.functions.bands import (  # noqa: F401
    compliance_threshold,
    confidence_weighted,
    format_dimension_name,
    format_score,
    is_blank,
    is_passing,
    let,
    normalize_dimension,
    preview,
    resolve_framework,
    risk_band,
    score_color,
    score_grade,
    score_label,
    severity_level,
)
from guardlake.functions.dimensions import (  # noqa: F401
    dimension_columns,
    dimension_entries,
    dimension_map,
    dimensions_below,
    failed_dimensions,
    failed_dimensions_by,
    highest_dimension,
    lowest_dimension,
    restrict_dimensions,
    weighted_score,
)
from guardlake.functions.weights import (  # noqa: F401
    normalize_weights,
    normalize_weights_100,
    weights_sum,
    weights_sum_ok,
)
