"""JSON texts decoded into typed fields, with repeated keys kept in order.

The source system's decoder walks the text key by key: a key matches a field
in any case, each match in turn is stored over the one before, null stores
nothing, and a wrong type under any match fails the text.  A parsed map has
lost the earlier matches, so the walk is done here on (key, value) pairs.
"""

from __future__ import annotations

import json


class Wrong(ValueError):
    """A value's type does not fit its field."""


class Pairs(list):
    """An object as its (key, value) pairs in document order."""


class NotWhole:
    """A number with a fraction or an exponent, or one beyond 64 bits."""


def _whole(digits: str):
    return int(digits) if len(digits) <= 20 and -(1 << 63) <= int(digits) < 1 << 63 else NotWhole


def _not_whole(_: str):
    return NotWhole


def _no_constant(name: str):
    raise ValueError(name)


def parse(text: str):
    """The one JSON value that the text is; ValueError for anything else
    (text behind the value, NaN, nesting beyond the interpreter's)."""
    try:
        return json.loads(text, object_pairs_hook=Pairs, parse_int=_whole, parse_float=_not_whole, parse_constant=_no_constant)
    except RecursionError as deep:
        raise ValueError("nested too deep") from deep


def fill(kind, value, old=None):
    """``value`` as ``kind``: str, int, a dict of fields or a list of one
    kind.  Null leaves ``old``; objects are filled over it."""
    if kind is str or kind is int:
        if value is None:
            return old
        if type(value) is not kind:
            raise Wrong
        return value
    if isinstance(kind, list):
        if value is None:
            return None
        if type(value) is not list:
            raise Wrong
        return [fill(kind[0], item) for item in value]
    out = dict(old) if old else {}
    if value is None:
        return out
    if type(value) is not Pairs:
        raise Wrong
    for key, item in value:
        name = key.casefold()
        if name in kind:
            out[name] = fill(kind[name], item, out.get(name))
    return out
