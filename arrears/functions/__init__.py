from .columns import (  # noqa: F401
    bucket_label,
    decay_weighted,
    discount_offered,
    in_year_range,
    minmax,
    not_true,
    payment_bucket,
    delay_days,
)
