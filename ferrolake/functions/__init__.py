from .columns import (  # noqa: F401
    customer_status, days_between, days_since, email_hash, full_name, money, norm_lower, norm_title,
    norm_upper, rolling_sum, safe_divide, size_band, surrogate_key, to_key,
)
