from .columns import (  # noqa: F401
    amount_bucket,
    balance_ratio,
    code_lookup,
    entry_mode_code,
    hash_unit,
    hour_of,
    is_fraud,
    is_merchant,
    parse_ts,
    prob_class1,
    transaction_id,
    type_code,
    vec_item,
)
from .ordering import global_rank, exact_quantiles  # noqa: F401
