import math
import struct


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN " + struct.pack(">d", v).hex()  # bit for bit: a NaN with another sign is another value
        return repr(round(v, 9)) if abs(v) != math.inf else repr(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, dict):
        v = list(v.values())
    if isinstance(v, (list, tuple)):
        return repr([norm(x) for x in v])
    return repr(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)
