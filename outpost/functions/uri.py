"""Endpoint addresses as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DEFAULT_PORT = 9494


def parse_endpoint(uri: Column, scheme: str, ssl: bool = False, default_port: int = DEFAULT_PORT) -> Column:
    """Struct ``host, port, ipv6, ssl, url`` of ``<scheme>:host[:port]``, IPv6 hosts in brackets; null for
    null and for what is no such address."""
    rest = F.regexp_extract(uri, f"(?i)^{scheme}:(?://)?(.+)$", 1)
    v6 = rest.startswith("[")
    host = F.when(v6, F.regexp_extract(rest, "^\\[([0-9a-fA-F:.]+)\\]", 1)).otherwise(F.regexp_extract(rest, "^([^:\\[\\]/]+)", 1))
    tail = F.when(v6, F.regexp_extract(rest, "^\\[[^\\]]*\\](.*)$", 1)).otherwise(F.regexp_extract(rest, "^[^:]*(.*)$", 1))
    port = F.when(tail == "", F.lit(default_port)).when(tail.rlike("^:[0-9]{1,5}$"), F.substring(tail, 2, 5).cast("int"))
    local = host.isin("localhost", "127.0.0.1", "::1")
    secure = F.lit(ssl) & ~local
    url = F.concat(F.when(secure, "https://").otherwise("http://"), F.when(v6, F.concat(F.lit("["), host, F.lit("]"))).otherwise(host), F.lit(":"), port.cast("string"))
    ok = (host != "") & port.between(1, 65535)
    return F.when(ok, F.struct(host.alias("host"), port.alias("port"), v6.alias("ipv6"), secure.alias("ssl"), url.alias("url")))
