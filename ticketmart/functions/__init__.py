"""Column expressions; each takes and gives a Column and stays inside the JVM."""

from ticketmart.functions.columns import (
    any_of,
    drop_day,
    drop_path,
    full_name,
    normal_channel,
    reseller_from_file,
    sale_day,
    seller_type,
)

__all__ = ["any_of", "drop_day", "drop_path", "full_name", "normal_channel", "reseller_from_file", "sale_day", "seller_type"]
