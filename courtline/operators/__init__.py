"""Relational operators of the pipelines, as DataFrame -> DataFrame functions."""

from courtline.operators.aside import lockstep_marked, set_aside, stage_aside  # noqa: F401
from courtline.operators.change import changed_rows, dedup_batch, merge_keyed  # noqa: F401
from courtline.operators.expand import (  # noqa: F401
    explode_keep_empty,
    lockstep_explode,
    split_fixed,
    union_all_by_name,
)
from courtline.operators.fill import (  # noqa: F401
    fill_zero,
    forward_fill,
    label_markers,
    minute_bucket,
    period_from_markers,
)
from courtline.operators.filters import (  # noqa: F401
    any_present,
    contains,
    not_equal_keep_null,
    not_in_keep_null,
    present,
    starts_with,
)
from courtline.operators.joins import (  # noqa: F401
    exists_on,
    lookup_by_key,
    natural_join,
    page_key,
)
from courtline.operators.keyed import (  # noqa: F401
    distinct_rows,
    duplicate_keys,
    first_nonnull_per_group,
    keep_first_per_key,
    keep_last_per_key,
    order_key,
)
from courtline.operators.quality import (  # noqa: F401
    QualityError,
    quarantine,
    require_columns,
    require_non_empty_column,
    require_types,
)
