"""Job parameters as they come from a scheduler: a flat map of texts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from cumulo.functions.text import ALL_REGIONS_TOKENS, STANDARD_REGIONS
from cumulo.operators.catalog import DEFAULT_SERVICE

# Parameters that may name target accounts, in the order they are read.
OWN_ACCOUNT_PARAMETER = "AWS_ACCOUNT_ID"
ACCOUNT_PARAMETERS = ("CLOUD_ACCOUNT_ID", "ACCOUNT_ID", "ACCOUNT_IDS")


@dataclass(frozen=True)
class IngestParams:
    client_id: str
    database: str
    additional_client_id: str = ""
    services: tuple[str, ...] = (DEFAULT_SERVICE,)
    accounts: tuple[str, ...] = ()
    regions: tuple[str, ...] = ()
    window_days: int = 7
    provider: str = "parquet"
    warehouse: str = ""
    # Roll up the look-back window, or only the days that raw points were merged into since they were last rolled up.
    changes_only: bool = False


def _items(text: str | None) -> list[str]:
    return [item for item in (part.strip() for part in (text or "").split(",")) if item]


def wants_all(names: Sequence[str], tokens: Sequence[str]) -> bool:
    return not names or (len(names) == 1 and names[0].strip().upper() in tokens)


def parse_params(raw: Mapping[str, str]) -> IngestParams:
    """An empty ``regions`` means every landed region, empty ``accounts`` every landed account,
    and empty ``services`` that the catalog decides. With a catalog named, tables are of the
    row-level format, in that catalog and under the bucket."""
    services = [s.upper() for s in _items(raw.get("ACTIVE_SERVICES"))]
    regions = _items(raw.get("AWS_REGIONS") or raw.get("AWS_REGION"))
    named = [raw.get(key) or "" for key in ACCOUNT_PARAMETERS]
    # The job's own account is the scope only where no target account is named.
    texts = named if any(named) else [raw.get(OWN_ACCOUNT_PARAMETER) or ""]
    accounts = [found for text in texts for found in re.findall(r"\b\d{12}\b", text)]
    catalog, bucket = raw.get("ICEBERG_CATALOG") or "", raw.get("S3_BUCKET") or ""
    return IngestParams(
        client_id=raw["CLIENT_ID"],
        database=".".join(filter(None, (catalog, raw["ICEBERG_DATABASE"]))),
        additional_client_id=raw.get("ADDITIONAL_CLIENT_ID", ""),
        services=() if wants_all(services, ("ALL",)) else tuple(services),
        accounts=tuple(dict.fromkeys(accounts)),
        regions=() if wants_all(regions, ALL_REGIONS_TOKENS) else tuple(regions),
        window_days=int(raw.get("WINDOW_DAYS", "7")),
        provider="iceberg" if catalog else "parquet",
        warehouse=f"s3://{bucket}/warehouse" if catalog and bucket else "",
    )


def regions_without_listing(override: str = "") -> list[str]:
    """Regions to use when the enabled ones may not be listed."""
    return sorted(_items(override)) or list(STANDARD_REGIONS)
