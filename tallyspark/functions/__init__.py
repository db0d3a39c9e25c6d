from tallyspark.functions.exprs import (  # noqa: F401
    AGING_LABELS,
    CHANNEL_ORDER,
    aging_key,
    aging_label,
    bucket_rank,
    channel_rank,
    churn_channel,
    guarded_div,
    norm_key,
    perf_bucket,
    quarter_label,
    round_half_away,
    safe_div,
    week_start,
)
