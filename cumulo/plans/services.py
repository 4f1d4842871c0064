"""Registered services: what a service's documents become, and what is measured on it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cumulo.operators.catalog import DEFAULT_SERVICE, active_codes, registered_codes
from cumulo.operators.inventory import flatten_instances, listed_instances, parsed_instances
from cumulo.schemas import (
    INSTANCE_SPECS,
    INVENTORY,
    RAW_METRICS,
    VOLUME_SPECS,
    MetricSpec,
    Table,
)


@dataclass(frozen=True)
class Service:
    name: str
    namespace: str
    inventory: Table
    # Pages as rows to stage, and staged rows as resources.
    listed: Callable[[DataFrame], DataFrame]
    resources: Callable[[DataFrame], DataFrame]
    metrics: Table | None = None
    instance_specs: tuple[MetricSpec, ...] = ()
    volume_specs: tuple[MetricSpec, ...] = ()
    percentile: float = 0.9

    @property
    def specs(self) -> tuple[MetricSpec, ...]:
        return self.instance_specs + self.volume_specs


_SERVICES: dict[str, Service] = {}


def register(service: Service) -> None:
    _SERVICES[service.name.upper()] = service


def service_named(name: str) -> Service | None:
    return _SERVICES.get(name.upper())


def registered_names() -> list[str]:
    return list(_SERVICES)


def active_services(requested: Sequence[str], catalog: DataFrame | None) -> list[str]:
    """The services to run: those requested, else the registered active ones of the catalog, else
    the default. What is collected is bounded by the registry."""
    if requested:
        return [name.upper() for name in requested]
    if catalog is None:
        return [DEFAULT_SERVICE]
    codes = registered_codes(active_codes(catalog), registered_names())
    return sorted(row.service_code for row in codes.collect())


def _listed(pages: DataFrame) -> DataFrame:
    return listed_instances(pages, *[c for c in pages.columns if c not in ("Reservations", "malformed")])


def _compute_instances(listed: DataFrame) -> DataFrame:
    return flatten_instances(parsed_instances(listed))


register(
    Service(
        name="EC2",
        namespace="AWS/EC2",
        inventory=INVENTORY,
        listed=_listed,
        resources=_compute_instances,
        metrics=RAW_METRICS,
        instance_specs=INSTANCE_SPECS,
        volume_specs=VOLUME_SPECS,
    )
)
