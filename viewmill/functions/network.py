"""IP addresses as numbers and as keys that sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"


def ipv4_number(ip: Column) -> Column:
    """Dotted IPv4 text as bigint, NULL where the text is no IPv4 address."""

    def octet(n: int) -> Column:
        return F.substring_index(F.substring_index(ip, ".", n), ".", -1).try_cast("bigint")

    number = octet(1) * 16777216 + octet(2) * 65536 + octet(3) * 256 + octet(4)
    return F.when(ip.rlike(IPV4), number)


# The first bytes of keys of the two families, and what an IPv4 address written as IPv6 begins with.
_V4, _V6, _MAPPED = "04", "06", "00000000000000000000FFFF"
_GROUP = "[0-9A-Fa-f]{1,4}"


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _groups(text: Column) -> Column:
    """The groups of a part of an IPv6 address as four digits each; a part may be empty."""
    padded = F.transform(F.split(text, ":"), lambda g: F.lpad(F.upper(g), 4, "0"))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(padded)


def _digits(text: Column) -> Column:
    """The 32 digits of groups of which a run of zeros may be left out, NULL if there are not eight."""

    def joined(parts: Column) -> Column:
        missing = 8 - F.size(parts["before"]) - F.size(parts["after"])
        zeros = F.array_repeat(F.lit("0000"), F.greatest(missing, F.lit(0)))
        groups = F.concat(parts["before"], zeros, parts["after"])
        whole = F.when(text.contains("::"), missing >= 1).otherwise(missing == 0)
        return F.when(whole, F.array_join(groups, ""))

    before = _groups(F.substring_index(text, "::", 1))
    after = F.when(text.contains("::"), _groups(F.substring_index(text, "::", -1)))
    parts = F.struct(before.alias("before"), F.coalesce(after, F.array().cast("array<string>")).alias("after"))
    return _with(parts, joined)


def _ipv6_digits(ip: Column) -> Column:
    """The 32 hexadecimal digits of an IPv6 address, NULL where the text is none."""

    def spelled(tail: Column) -> Column:
        # An IPv4 address at the end stands for the last two groups.
        last = F.lpad(F.hex(ipv4_number(tail)), 8, "0")
        groups = F.concat(F.substring(last, 1, 4), F.lit(":"), F.substring(last, 5, 4))
        return F.when(tail.rlike(IPV4), F.concat(F.substring(ip, F.lit(1), F.length(ip) - F.length(tail)), groups)).otherwise(ip)

    listed = rf"^({_GROUP}(:{_GROUP})*)?(::({_GROUP}(:{_GROUP})*)?)?\z"
    text = _with(F.substring_index(ip, ":", -1), spelled)
    return F.when(ip.contains(":"), _with(text, lambda t: F.when(t.rlike(listed), _digits(t))))


def ipv4_key(number: Column) -> Column:
    """The key of an IPv4 address given as a number."""
    return F.unhex(F.concat(F.lit(_V4), F.lpad(F.hex(number), 8, "0")))


def ip_key(ip: Column) -> Column:
    """Binary key of an IPv4 or IPv6 address, NULL where the text is neither. Keys sort as addresses do, IPv4 first; an
    IPv4 address written as IPv6 (``::ffff:1.2.3.4``) has the key it has as IPv4."""
    def key(digits: Column) -> Column:
        mapped = F.concat(F.lit(_V4), F.substring(digits, 25, 8))
        return F.unhex(F.when(digits.startswith(_MAPPED), mapped).otherwise(F.concat(F.lit(_V6), digits)))

    number = ipv4_key(ipv4_number(ip))
    return F.when(ip.contains(":"), _with(_ipv6_digits(ip), key)).otherwise(number)


def key_position(key: Column) -> Column:
    """A number that never falls from one key to the next: what the first 56 bits of an address amount to."""
    digits = F.rpad(F.substring(F.hex(key), 3, 14), 14, "0")
    family = F.when(F.hex(F.substring(key, 1, 1)) == _V6, F.lit(2.0**56)).otherwise(F.lit(0.0))
    return F.conv(digits, 16, 10).cast("double") + family
