"""Keys for row access and PII tags."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contrail.catalog import q
from contrail.fixtures import Tables
from contrail.functions import masking as M
from contrail.operators import governance as G

# The user whose entitlements the registered query applies.
USER = "analyst0"


@q("row_access_filter")
def row_access_filter(t: Tables) -> DataFrame:
    f = G.row_access_filter(t.fact_flight, t.user_airline_access, USER, M.ANALYST)
    return f.select("flight_key", "airline_code")


@q("pii_tag_report")
def pii_tag_report(t: Tables) -> DataFrame:
    p = G.tag_report(G.tag_columns(t.dim_passenger, G.PII_TAGS["dim_passenger"]), "dim_passenger")
    r = G.tag_report(G.tag_columns(t.fact_reservation, G.PII_TAGS["fact_reservation"]),
                     "fact_reservation")
    return p.unionByName(r)


@q("masked_view_reader")
def masked_view_reader(t: Tables) -> DataFrame:
    """dim_passenger as the reader role sees it: every PII-tagged column masked
    by its policy (untagged columns pass through)."""
    p = G.tag_columns(t.dim_passenger, G.PII_TAGS["dim_passenger"])
    return G.masked_view(p, M.READER).select("passenger_key", "passenger_id", "email", "phone", "dob",
                                            "loyalty_tier")
