"""Column-expression helpers that rebuild JVM string rules with built-in functions."""

from strata.functions.strings import (
    char_class, java_split, jvm_trim, literal_regex, parse_double,
    round_to_float, split_head, split_quoted,
)

__all__ = [
    "char_class", "java_split", "jvm_trim", "literal_regex",
    "parse_double", "round_to_float", "split_head", "split_quoted",
]
