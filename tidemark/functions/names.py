"""Application-name rules of network flows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names, ports and patterns the rules are defined by.
AUTO_NAME = r"^.*:\d+(?:_(?:UDP|TCP))?$"
OVER_HTTP = "over-http"
TCP = 6
HTTP_PORT = 80
HTTPS_PORT = 443
UNKNOWN = "unknown"
UNKNOWN_NAMES = ("unknown", "Unknown")


def resolved_app_name(
    app: Column,
    proto: Column,
    port: Column,
    in_taxonomy: Column,
    unknown: str = UNKNOWN,
) -> Column:
    """Standard name of an application; the first rule that holds decides.

    Names that look like ``host:port`` or contain a dot are customer-defined:
    over TCP they become the protocol of the well-known port. Names outside the
    taxonomy become ``ssl`` (a server name over TCP) or ``unknown``.
    """
    tcp = proto.eqNullSafe(F.lit(TCP))
    generated = app.rlike(AUTO_NAME)
    dotted = app.contains(".")
    tunnelled = app.contains(OVER_HTTP)
    web_ssl, web_http = app.startswith("ssl-"), app.startswith("http-")
    carrier = F.when(web_ssl, "ssl").when(web_http, "http").otherwise(app)
    known = F.coalesce(in_taxonomy, F.lit(False))
    return (
        F.when((dotted | generated) & tcp & (port == HTTPS_PORT), "https")
        .when((dotted | generated) & tcp & (port == HTTP_PORT), "http")
        .when(tunnelled & ~tcp, unknown)
        .when(tunnelled, F.concat(F.substring_index(carrier, OVER_HTTP, 1), F.lit(OVER_HTTP)))
        .when(web_ssl & tcp, "ssl")
        .when(web_http & tcp, "http")
        .when(~known & tcp & dotted & ~generated, "ssl")
        .when(~known, unknown)
        .otherwise(app)
    )
