"""IP addresses as the INET type takes and prints them (SC-8, Q-9), both families, as Column expressions.

A value is an IPv4 or IPv6 address with an optional mask length.  Host bits stay.  An address
prints in one canonical form whatever its spelling: IPv6 in lower case without leading zeros, the
first longest run of two or more zero groups as ``::``, and an embedded IPv4 address dotted.  The
mask is left out where it covers the whole address; as text (a cast) it is always there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An octet of 0 to 255 without leading zeros; mask lengths of both families; the text forms of both.
OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4_ADDRESS = rf"{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}"
IPV4_PATTERN = rf"^{IPV4_ADDRESS}(/([0-9]|[12][0-9]|3[0-2]))?$"
IPV6_SHAPE = rf"^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*({IPV4_ADDRESS})?(/([0-9]|[1-9][0-9]|1[01][0-9]|12[0-8]))?$"
IPV4_BITS, IPV6_BITS = 32, 128


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def is_ipv4(c: Column | str) -> Column:
    """True when the text is a dotted-quad IPv4 address (optional /mask)."""
    return _col(c).rlike(IPV4_PATTERN)


def _address(c: Column) -> Column:
    return F.substring_index(c, "/", 1)


def _groups(c: Column) -> Column:
    """The eight 16-bit groups of an IPv6 address as hexadecimal texts; NULL if it is none."""
    tail = F.regexp_extract(c, rf"({IPV4_ADDRESS})$", 1)
    octets = F.split(tail, r"[.]")
    o = [F.get(octets, i).try_cast("int") for i in range(4)]
    dotted = F.concat(F.substring(c, F.lit(1), F.length(c) - F.length(tail)),
                      F.lower(F.hex(o[0] * 256 + o[1])), F.lit(":"), F.lower(F.hex(o[2] * 256 + o[3])))
    plain = F.when(c.contains("."), dotted).otherwise(c)

    def read(address: Column) -> Column:
        halves = F.split(address, "::")

        def side(i: int) -> Column:
            half = F.get(halves, i)
            return F.when(half.isNull() | (half == ""), F.array().cast("array<string>")).otherwise(F.split(half, ":"))
        short = F.size(halves) == 2
        given = F.size(side(0)) + F.size(side(1))
        zeros = F.array_repeat(F.lit("0"), F.lit(8) - given)
        all_ = F.when(short & (given <= 7), F.concat(side(0), zeros, side(1))).when(F.size(halves) == 1, side(0))
        fine = (F.size(all_) == 8) & F.forall(all_, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(fine, all_)
    return _let(plain, read)


def ipv6_groups(c: Column | str) -> Column:
    """The eight groups of an IPv6 address as numbers (array<int>); NULL for any other text."""
    c = _col(c)
    groups = F.when(c.rlike(IPV6_SHAPE), _groups(F.lower(_address(c))))
    return F.transform(groups, lambda g: F.conv(g, 16, 10).cast("int"))


def is_inet(c: Column | str) -> Column:
    """True for an IPv4 or IPv6 address with an optional mask; NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), is_ipv4(c) | (c.contains(":") & ipv6_groups(c).isNotNull()))


def _hex_of(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.lower(F.hex(w.cast("bigint")))), ":")


def _ipv6_text(words: Column) -> Column:
    """The canonical text of eight groups."""
    state = F.struct(*[F.lit(v).alias(n) for n, v in (("at", 0), ("start", 0), ("length", 0), ("best", -1), ("most", 0))])

    def step(s: Column, w: Column) -> Column:
        length = F.when(w == 0, s["length"] + 1).otherwise(0)
        start = F.when((w == 0) & (s["length"] == 0), s["at"]).otherwise(s["start"])
        better = length > s["most"]
        return F.struct((s["at"] + 1).alias("at"), start.alias("start"), length.alias("length"),
                        F.when(better, start).otherwise(s["best"]).alias("best"), F.when(better, length).otherwise(s["most"]).alias("most"))

    def show(run: Column) -> Column:
        first, most = run["best"], run["most"]
        v4 = F.concat_ws(".", *[e.cast("string") for e in (F.shiftright(words[6], 8), words[6].bitwiseAND(255),
                                                           F.shiftright(words[7], 8), words[7].bitwiseAND(255))])
        embedded = (first == 0) & ((most == 6) | ((most == 7) & (words[7] != 1)) | ((most == 5) & (words[5] == 0xFFFF)))
        left = _hex_of(F.slice(words, F.lit(1), first))
        right = _hex_of(F.slice(words, first + most + 1, F.greatest(F.lit(8) - first - most, F.lit(0))))
        return (F.when(embedded, F.concat(F.when(most == 5, F.lit("::ffff:")).otherwise("::"), v4))
                .when(most < 2, _hex_of(words)).otherwise(F.concat(left, F.lit("::"), right)))
    return _let(F.aggregate(words, state, step), show)


def canonical(c: Column | str) -> Column:
    """The address as INET prints it; NULL for a text that is no address."""
    c = _col(c)
    mask = F.when(c.contains("/"), F.substring_index(c, "/", -1).try_cast("int"))

    def printed(address: Column, bits: int) -> Column:
        return F.when(mask.isNull() | (mask == bits), address).otherwise(F.concat(address, F.lit("/"), mask.cast("string")))
    v6 = _let(ipv6_groups(c), lambda words: F.when(words.isNotNull(), printed(_ipv6_text(words), IPV6_BITS)))
    return F.when(is_ipv4(c), printed(_address(c), IPV4_BITS)).when(c.contains(":"), v6)


def inet(c: Column | str, on_invalid: str = "raise") -> Column:
    """``x::INET`` (SC-8): the canonical address.  ``on_invalid`` is ``"raise"`` (the load fails, as the
    database would) or ``"null"``."""
    c = _col(c)
    value = canonical(c)
    if on_invalid == "null":
        return value
    if on_invalid != "raise":
        raise ValueError("on_invalid must be 'raise' or 'null'")
    return F.when(c.isNotNull(), F.coalesce(
        value, F.raise_error(F.concat(F.lit("invalid input syntax for type inet: "), c)).cast("string")))


def inet_text(c: Column | str) -> Column:
    """Text of an INET value: its mask is always there (Q-9), ``/32`` or ``/128`` for a host."""
    c = _col(c)
    whole = F.when(c.contains(":"), F.lit(f"/{IPV6_BITS}")).otherwise(F.lit(f"/{IPV4_BITS}"))
    return F.when(c.contains("/"), c).otherwise(F.concat(c, whole))


def inet_order(c: Column | str) -> Column:
    """A binary key that sorts addresses as INET does, the IPv4 family first, then by all 128 (or 32) bits,
    then by mask: 18 bytes whatever the spelling.  NULL for a text that is no address."""
    c = _col(c)
    octets = F.transform(F.split(_address(c), r"[.]"), lambda o: F.lpad(F.hex(o.try_cast("int")), 2, "0"))
    v4 = F.concat(F.lit("04"), F.rpad(F.array_join(octets, ""), 32, "0"))
    v6 = F.concat(F.lit("06"), F.array_join(F.transform(ipv6_groups(c), lambda w: F.lpad(F.hex(w.cast("bigint")), 4, "0")), ""))
    bits = F.when(is_ipv4(c), IPV4_BITS).otherwise(IPV6_BITS)
    mask = F.lpad(F.hex(F.coalesce(F.when(c.contains("/"), F.substring_index(c, "/", -1).try_cast("int")), bits).cast("bigint")), 2, "0")
    return F.unhex(F.concat(F.when(is_ipv4(c), v4).when(c.contains(":"), v6), mask))
