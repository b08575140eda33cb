"""Plain model of strict JSON objects as key -> compact value text, which the column expressions must equal."""

import json
import math
from decimal import Decimal

MAX_CONTAINERS = 127


def number_text(x):
    if x == 0:
        return "-0.0" if math.copysign(1, x) < 0 else "0.0"
    sign, digits, exponent = Decimal(repr(x)).normalize().as_tuple()
    d, point = "".join(map(str, digits)), len(digits) + exponent
    if 0 <= exponent and point <= 16:
        body = d + "0" * exponent + ".0"
    elif 0 < point <= 16:
        body = f"{d[:point]}.{d[point:]}"
    elif -5 < point <= 0:
        body = f"0.{'0' * -point}{d}"
    else:
        body = f"{d[0]}{'.' if len(d) > 1 else ''}{d[1:]}e{point - 1}"
    return "-" * sign + body


def _float(text):
    x = float(text)
    if math.isinf(x):
        raise ValueError("number out of range")
    return x


def _int(text):
    x = int(text) if len(text) < 400 else _float(text)
    if x == 0 and text[0] == "-":
        return -0.0
    return x if -(2**63) <= x < 2**64 else _float(text)


def _constant(text):
    raise ValueError(f"no JSON value: {text}")


def _text(v, left):
    if isinstance(v, (dict, list)):
        if not left:
            raise ValueError("nested too deeply")
        if isinstance(v, list):
            return f"[{','.join(_text(x, left - 1) for x in v)}]"
        return f"{{{','.join(f'{_text(k, 1)}:{_text(v[k], left - 1)}' for k in sorted(v))}}}"
    if isinstance(v, float):
        return number_text(v)
    if isinstance(v, str):
        v.encode("utf-8")  # a lone surrogate fails here
        return json.dumps(v, ensure_ascii=False)
    return json.dumps(v)


def strict_object(data):
    """None for invalid JSON, "" for a value that is no object, else a dict of key -> value text."""
    try:
        v = json.loads(bytes(data).decode("utf-8"), parse_float=_float, parse_int=_int, parse_constant=_constant)
        _text(v, MAX_CONTAINERS)
    except (ValueError, RecursionError, TypeError):
        return None
    if not isinstance(v, dict):
        return ""
    return {k: _text(x, MAX_CONTAINERS - 1) for k, x in v.items()}
