"""Reuse of built Column expressions.

A Column is an unresolved, immutable expression tree that names its inputs,
so the same object can be used by any number of DataFrames. Building a wide
expression (a payload struct, a routing CASE) costs thousands of driver-JVM
round trips; ``expression_cache`` builds each one once per JVM gateway and
parameter set.
"""

from __future__ import annotations

import functools
import threading


def _gateway_id() -> int:
    from pyspark import SparkContext
    return id(SparkContext._gateway)


def expression_cache(fn):
    """Memoise a Column builder on (gateway, arguments); arguments must be hashable."""
    lock = threading.Lock()
    memo: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        key = (_gateway_id(), args, tuple(sorted(kwargs.items())))
        with lock:
            hit = memo.get(key)
        if hit is None:
            hit = fn(*args, **kwargs)
            with lock:
                memo[key] = hit
        return hit

    wrapper.cache_clear = memo.clear
    return wrapper
