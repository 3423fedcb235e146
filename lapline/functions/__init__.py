from lapline.functions.columns import (
    eq_or_false,
    is_street_circuit,
    is_true,
    nan_to_null,
    one_hot,
    seconds_of,
)

__all__ = ["eq_or_false", "is_street_circuit", "is_true", "nan_to_null",
           "one_hot", "seconds_of"]
