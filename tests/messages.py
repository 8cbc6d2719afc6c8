"""Log messages for tests, from the layouts of the public protocol pages ("Logical Replication Message
Formats"). A layout names the fields of a message in order; `literal` messages in the tests are
written out byte by byte and check both this file and the package."""

UNCHANGED = object()

# Field -> bytes it takes, for whole numbers in network order.
WIDTHS = {"oid": 4, "xid": 4, "lsn": 8, "time": 8, "columns": 2, "type": 4, "modifier": 4, "length": 4, "flags": 1}
LAYOUTS = {
    "begin": "'B' lsn time xid",
    "relation": "'R' oid namespace: table: 'd' columns described",
    "column": "flags name: type modifier",
    "insert": "'I' oid 'N' new",
    "update": "'U' oid old 'N' new",
    "delete": "'D' oid old",
    "image": "columns values",
    "value": "kind length content",
}


def spelled(layout, **given):
    """The bytes of a layout: quoted letters as they are, names with a colon end in a zero byte,
    numbers by their width, anything else is bytes already."""
    out = bytearray()
    for field in LAYOUTS[layout].split():
        name = field.strip("':")
        value = given.get(name)
        if field[0] == "'":
            out += name.encode()
        elif field[-1] == ":":
            out += (value if isinstance(value, bytes) else value.encode()) + b"\0"
        elif name in WIDTHS:
            out += (value % 256 ** WIDTHS[name]).to_bytes(WIDTHS[name], "big")
        else:
            out += value
    return bytes(out)


def value(v):
    if v is None:
        return b"n"
    if v is UNCHANGED:
        return b"u"
    kind, content = (b"b", v) if isinstance(v, bytes) else (b"t", v.encode() if isinstance(v, str) else bytes(v))
    return spelled("value", kind=kind, length=len(content), content=content)


def row(values):
    return spelled("image", columns=len(values), values=b"".join(map(value, values)))


def begin(lsn, micros, xid=1):
    return spelled("begin", lsn=lsn, time=micros, xid=xid)


def commit():
    return b"C" + bytes(25)


def relation(oid, table, columns, namespace="public"):
    """columns: (name, type oid, is key)"""
    described = b"".join(spelled("column", flags=int(k), name=n, type=t, modifier=-1) for n, t, k in columns)
    return spelled("relation", oid=oid, namespace=namespace, table=table, columns=len(columns), described=described)


def insert(oid, new):
    return spelled("insert", oid=oid, new=row(new))


def update(oid, new, old=None, tag=b"O"):
    return spelled("update", oid=oid, old=b"" if old is None else tag + row(old), new=row(new))


def delete(oid, old, tag=b"K"):
    return spelled("delete", oid=oid, old=tag + row(old))
