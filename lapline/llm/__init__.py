"""Training-data operators: chat parsing, scoring, de-duplication, mixing, sharding, packing.

One module per operator; ``queries`` registers one ``opN_*`` query for each.
Nothing outside this package imports it.
"""
