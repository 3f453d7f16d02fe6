"""IP address functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
# Eight groups, or fewer with one "::", the last two groups possibly written as IPv4.
_GROUPS = r"[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4})*"
_TAIL4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_IPV6_SHAPE = rf"^(?:{_GROUPS})?(?:::)?(?:{_GROUPS})?(?::?{_TAIL4})?$"


def is_ipv4(ip: Column) -> Column:
    return ip.rlike(IPV4)


def is_ipv6(ip: Column) -> Column:
    """Shape, at most one ``::`` and the right number of groups."""
    bare = F.regexp_replace(ip, r"%.+$", "")
    # An embedded IPv4 tail stands for two groups.
    plain = F.regexp_replace(bare, rf"{_TAIL4}$", "0:0")
    groups = F.size(F.filter(F.split(plain, ":"), lambda g: g != ""))
    gaps = (F.length(bare) - F.length(F.replace(bare, F.lit("::"), F.lit("")))) / 2
    return (
        bare.rlike(_IPV6_SHAPE)
        & F.contains(bare, F.lit(":"))
        & ~F.contains(bare, F.lit(":::"))
        & ~bare.rlike(r"^:[^:]|[^:]:$")
        & (((gaps == 0) & (groups == 8)) | ((gaps == 1) & (groups <= 7)))
    )


def ip_family(ip: Column) -> Column:
    """4, 6, or NULL for text that is no address."""
    return F.when(is_ipv4(ip), 4).when(is_ipv6(ip), 6)


def ipv6_flag(ip: Column) -> Column:
    return F.coalesce(is_ipv6(ip), F.lit(False)).cast("int")


def address_halves(ip: Column) -> Column:
    """struct(family, hi, lo), the address as two longs that sort like the address; NULL for text that is no address.

    Both halves of an IPv6 address have their first bit turned, so that signed order is the order of addresses. IPv4 has hi = 0.
    """
    bare = F.regexp_replace(ip, r"%.+$", "")
    # An embedded IPv4 tail as two groups.
    tail = F.split(F.regexp_extract(bare, rf"{_TAIL4}$", 0), r"\.")
    pair = [
        F.hex(F.get(tail, F.lit(i)).try_cast("int") * 256 + F.get(tail, F.lit(i + 1)).try_cast("int")) for i in (0, 2)
    ]
    front = F.regexp_replace(bare, rf"{_TAIL4}$", "")
    whole = F.when(F.contains(bare, F.lit(".")), F.concat(front, pair[0], F.lit(":"), pair[1])).otherwise(bare)
    sides = F.transform(F.split(whole, "::", -1), lambda side: F.filter(F.split(side, ":"), lambda g: g != ""))
    left, right = F.get(sides, F.lit(0)), F.coalesce(F.get(sides, F.lit(1)), F.array().cast("array<string>"))
    gap = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right)))
    numbers = F.transform(F.concat(left, gap, right), lambda g: F.conv(g, 16, 10).try_cast("bigint"))
    half = lambda at: F.aggregate(F.slice(numbers, at, 4), F.lit(0).cast("bigint"), lambda a, g: F.shiftleft(a, 16).bitwiseOR(g))
    turned = F.lit(-(2**63)).cast("bigint")
    six = F.struct(F.lit(6).alias("family"), half(1).bitwiseXOR(turned).alias("hi"), half(5).bitwiseXOR(turned).alias("lo"))
    four = F.struct(F.lit(4).alias("family"), F.lit(0).cast("bigint").alias("hi"), ipv4_number(ip).alias("lo"))
    return F.when(is_ipv4(ip), four).when(is_ipv6(ip), six)


def network_bounds(address: Column, width: Column) -> tuple[Column, Column]:
    """First and last address of the block of a width around an address, all as ``address_halves``.

    ``width`` counts leading bits and must fit the family.
    """
    family, hi, lo = address["family"], address["hi"], address["lo"]
    free = F.when(family == 4, 32 - width).otherwise(128 - width)

    def filled(half: Column, bits: Column, on: bool) -> Column:
        # Turned halves: all bits off is the least long, all on the greatest.
        all_bits = F.lit(2**63 - 1 if on else -(2**63)).cast("bigint")
        mask = F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.least(F.greatest(bits, F.lit(0)), F.lit(63)))
        changed = half.bitwiseOR(F.bitwise_not(mask)) if on else half.bitwiseAND(mask)
        return F.when(bits >= 64, all_bits).otherwise(changed)

    def end(on: bool) -> Column:
        high = F.when(family == 4, hi).otherwise(filled(hi, free - 64, on))
        return F.struct(family.alias("family"), high.alias("hi"), filled(lo, free, on).alias("lo"))

    return end(False), end(True)


def ipv4_number(ip: Column) -> Column:
    """The address as a number; NULL for anything but IPv4."""
    parts = F.split(ip, r"\.")
    value = F.lit(0).cast("bigint")
    for i in range(4):
        value = value * 256 + F.get(parts, F.lit(i)).try_cast("bigint")
    return F.when(is_ipv4(ip), value)
