"""Normal form of URLs and of request bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolayer.errors import InputTypeError

# Default ports left out of a normal URL.
DEFAULT_PORTS = {"http": "80", "https": "443"}
# A character no URL holds, put between the parts of one.
_GAP = "\x01"
_SHAPE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def body_text(body: Column) -> Column:
    """Text of a map body: sorted ``k=v`` joined by ``&``; empty for a null or empty map."""
    pairs = F.transform(
        F.array_sort(F.map_entries(body)),
        lambda e: F.concat(e.key, F.lit("="), F.coalesce(e.value, F.lit("None"))))
    return F.coalesce(F.array_join(pairs, "&"), F.lit(""))


def canonical(text: Column) -> Column:
    """One spelling of a name or value of a query: decoded, then percent-encoded.

    A ``+`` is a blank, and a ``%`` that starts no escape is itself. Only letters, digits and ``-._~`` stay
    unescaped. Escapes of bytes that are no UTF-8 stay escapes, in capitals, so that two such never become one.
    """
    whole = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    read = F.url_decode(whole)
    written = F.url_encode(read)
    for java, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        written = F.replace(written, F.lit(java), F.lit(plain))
    return F.when(F.contains(read, F.lit("\ufffd")), F.upper(whole)).otherwise(written)


def _pair(text: Column) -> Column:
    """Canonical form of ``name=value``, or of a name alone."""
    at = F.instr(text, "=")
    name = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text)
    value = F.substring(text, at + 1, F.length(text))
    return F.when(at > 0, F.concat(canonical(name), F.lit("="), canonical(value))).otherwise(canonical(name))


def query_pairs(query: Column) -> Column:
    """Canonical pairs of a query text, repeated names kept."""
    return F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), _pair)


def param_pairs(params: Column, dtype: T.DataType) -> Column:
    """Canonical pairs of parameters given in a column of type ``dtype``.

    That is a map, an array of two-field structs (which may repeat a name), or a query text, as string
    or bytes. Names and values of maps and arrays are taken as they are; a pair with a null in it is left out, and
    null parameters are none.
    """
    def encoded(name: Column, value: Column) -> Column:
        def one(v: Column) -> Column:
            # A mark of the coding inside a ready value is text.
            return canonical(F.replace(F.replace(
                v.cast("string"), F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B")))

        return F.concat(one(name), F.lit("="), one(value))

    if isinstance(dtype, T.MapType):
        pairs = F.transform(F.map_entries(params), lambda e: encoded(e.key, e.value))
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType) and (
            len(dtype.elementType) == 2):
        name, value = dtype.elementType.names
        pairs = F.transform(params, lambda e: encoded(e[name], e[value]))
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        pairs = query_pairs(F.regexp_replace(params.cast("string"), "^\\?", ""))
    else:
        raise InputTypeError("params", "a map, an array of two-field structs, a string or bytes")
    return F.coalesce(F.filter(pairs, lambda q: q.isNotNull()), F.array().cast("array<string>"))


def normalize_url(url: Column, params: Column | None = None, pairs: Column | None = None) -> Column:
    """Normal form: lower-case scheme and host, no default port or fragment, sorted query.

    Names and values of the query are written in one spelling (``canonical``), and repeated names stay.
    ``params``, a map, has further ones, and so have ``pairs``, which come from ``param_pairs``. Text that is no absolute
    URL stays as it is, and so does the spelling of a path.
    """
    if params is not None:
        mapped = param_pairs(params, T.MapType(T.StringType(), T.StringType()))
        pairs = mapped if pairs is None else F.concat(mapped, pairs)
    trimmed = F.trim(url)
    pieces = F.split(F.regexp_replace(trimmed, _SHAPE, f"$1{_GAP}$2{_GAP}$3{_GAP}$4"), _GAP)

    def normal(p: Column) -> Column:
        scheme, host = F.lower(F.get(p, F.lit(0))), F.lower(F.get(p, F.lit(1)))
        for name, port in DEFAULT_PORTS.items():
            host = F.when((scheme == name) & host.endswith(f":{port}"), F.substring(
                host, 1, F.length(host) - len(port) - 1)).otherwise(host)
        path = F.get(p, F.lit(2))
        held = query_pairs(F.substring(F.get(p, F.lit(3)), 2, 1 << 30))
        query = F.array_join(F.array_sort(held if pairs is None else F.concat(held, pairs)), "&")
        mark = F.when(query == "", "").otherwise("?")
        return F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), mark, query)

    joined = F.element_at(F.transform(F.array(pieces), normal), 1)
    return F.when(F.size(pieces) == 4, joined).otherwise(trimmed)


def request_key(
    method: Column, norm_url: Column, data: Column | None = None, json: Column | None = None
) -> Column:
    """SHA-256 of method, normal URL and both bodies, written one after the other.

    Bodies are maps or ready text; the same content in ``data`` and ``json`` shares a key.
    """
    empty = F.lit("")
    bodies = [empty if b is None else F.coalesce(b, empty) for b in (data, json)]
    return F.sha2(F.concat(F.upper(method), norm_url, *bodies), 256)
