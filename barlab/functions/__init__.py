from barlab.functions.columns import (
    flag,
    inf_to_null,
    round_doubles,
    tdiv,
)

__all__ = ["flag", "inf_to_null", "round_doubles", "tdiv"]
