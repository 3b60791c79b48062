"""Column-level functions: safe casts, code decoding, tiers, text."""

from ledgerline.functions.casts import month_date, safe_cast, safe_double, safe_int, strip_cast
from ledgerline.functions.codes import decode, tier
from ledgerline.functions.text import fill_template, mask_text, money, plain_text

__all__ = [
    "decode", "fill_template", "mask_text", "money", "month_date", "plain_text",
    "safe_cast", "safe_double", "safe_int", "strip_cast", "tier",
]
