"""Scalar semantics shared by every operator.

Arguments are column names or SQL expressions; each function gives one SQL
expression, so a report is built with few calls into the JVM.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.schemas import CORRUPT_COLUMN

_TCP = f"= '{K.PROTOCOL_TCP}'"
_UDP = f"= '{K.PROTOCOL_UDP}'"
_ALL = f"= '{K.PROTOCOL_ALL}'"


def text(value: str) -> str:
    """Document text as a value, of any length; empty text is NULL."""
    return f"nullif({value}, '')"


def struct(fields: dict[str, str]) -> str:
    """A struct of these expressions by their names."""
    return f"named_struct({', '.join(f"'{name}', {value}" for name, value in fields.items())})"


def elements(value: str) -> str:
    """JSON text of a list as an array of texts; anything else is a list of one."""
    return (
        f"CASE WHEN {value} LIKE '[%' THEN from_json({value}, 'array<string>')"
        f" WHEN {value} IS NOT NULL THEN array({value}) END"
    )


# Key under which a text is parsed; new in every process, so that no document can hold it.
PARSED_KEY = f"parsed-{uuid.uuid4().hex}"


def parsed(value: str, schema: str) -> str:
    """The elements of a list, each parsed on its own; a bad one keeps its place.

    A list without bad elements is parsed at once, which gives the same.
    """
    options = f"map('columnNameOfCorruptRecord', '{CORRUPT_COLUMN}')"
    element = " ".join(schema.split())
    one_by_one = f"transform({elements(value)}, e -> from_json(e, '{element}', {options}))"
    whole = f"""from_json(concat('{{"{PARSED_KEY}":', {value}, '}}'),
        '`{PARSED_KEY}` array<struct<{element}>>, {CORRUPT_COLUMN} string', {options})"""
    sound = f"""{value} LIKE '[%' AND w.{CORRUPT_COLUMN} IS NULL AND w.`{PARSED_KEY}` IS NOT NULL
        AND NOT exists(w.`{PARSED_KEY}`, r -> r.{CORRUPT_COLUMN} IS NOT NULL)"""
    return f"transform(array({whole}), w -> CASE WHEN {sound} THEN w.`{PARSED_KEY}` ELSE {one_by_one} END)[0]"


def port(value: str, bound: str = "floor") -> str:
    """Port number from text; ``22``, ``22.0`` and ``"22"`` agree, anything else is NULL.

    A fraction is rounded into the range: up (``ceil``) where it is a lower bound, down (``floor``)
    where it is an upper one, so the range covers the same ports.
    """
    # Digits alone need no decimal: most ports are written so. Whatever else a cast accepts, or overflows, is left to the decimal.
    digits = f"left({value}, 1) BETWEEN '0' AND '9' AND right({value}, 1) BETWEEN '0' AND '9'"
    whole = f"CASE WHEN {digits} THEN try_cast({value} AS BIGINT) END"
    return f"coalesce({whole}, try_cast({bound}(try_cast({value} AS DECIMAL(38, 10))) AS BIGINT))"


def _open(source: str, direction: str | None) -> str:
    to_any = f"{source} = '{K.ANY_SOURCE}'"
    return f"({to_any} AND {direction} = '{K.INGRESS}')" if direction else f"({to_any})"


def _every_port(protocol: str, has_tcp: str) -> str:
    return f"({protocol} {_ALL} OR ({protocol} {_TCP} AND NOT {has_tcp}))"


def _covers(number: int, low: str, high: str) -> str:
    return f"({low} IS NOT NULL AND {high} IS NOT NULL AND {number} BETWEEN {low} AND {high})"


def is_open(source: str = "source", direction: str | None = None) -> Column:
    """True for (ingress) rules open to any address."""
    return F.expr(_open(source, direction))


def insecure_case_sql(
    source: str = "source",
    protocol: str = "protocol",
    has_tcp: str = "has_tcp",
    low: str = "tcp_port_min",
    high: str = "tcp_port_max",
    direction: str | None = None,
) -> str:
    """``ALL``, ``22`` or ``3389`` for an over-permissive open rule, else NULL."""
    return f"""CASE WHEN {_open(source, direction)} THEN
              CASE WHEN {_every_port(protocol, has_tcp)} THEN '{K.CASE_ALL}'
                   WHEN {protocol} {_TCP} AND {_covers(K.SSH_PORT, low, high)} THEN '{K.CASE_SSH}'
                   WHEN {protocol} {_TCP} AND {_covers(K.RDP_PORT, low, high)} THEN '{K.CASE_RDP}'
              END END"""


def insecure_case(**names: str | None) -> Column:
    """``insecure_case_sql`` as a column."""
    return F.expr(insecure_case_sql(**names))


def is_other_sql(
    source: str = "source",
    protocol: str = "protocol",
    has_tcp: str = "has_tcp",
    low: str = "tcp_port_min",
    high: str = "tcp_port_max",
    direction: str | None = None,
) -> str:
    """True for open rules that are not insecure.

    Three-valued on purpose: a missing protocol makes the condition NULL, so
    the rule counts neither as insecure nor as other.
    """
    admin = f"({_covers(K.SSH_PORT, low, high)} OR {_covers(K.RDP_PORT, low, high)})"
    insecure = f"({_every_port(protocol, has_tcp)} OR ({protocol} {_TCP} AND {admin}))"
    return f"{_open(source, direction)} AND NOT {insecure}"


def is_other(**names: str | None) -> Column:
    """``is_other_sql`` as a column."""
    return F.expr(is_other_sql(**names))


def protocol_label(protocol: str = "protocol", upper_all: bool = False) -> Column:
    """``TCP`` and ``UDP`` for their numbers, other protocols unchanged."""
    upper = f"WHEN {protocol} {_ALL} THEN 'ALL'" if upper_all else ""
    return F.expr(
        f"CASE WHEN {protocol} {_TCP} THEN 'TCP' WHEN {protocol} {_UDP} THEN 'UDP' {upper} "
        f"ELSE {protocol} END"
    )


def _range_label(low: str, high: str) -> str:
    return f"""CASE WHEN {low} IS NULL OR {high} IS NULL THEN '{K.ALL_PORTS}'
                    WHEN {low} = {high} THEN CAST({low} AS STRING)
                    ELSE concat_ws('-', CAST({low} AS STRING), CAST({high} AS STRING)) END"""


def service_label(
    protocol: str = "protocol",
    tcp_low: str = "tcp_port_min",
    tcp_high: str = "tcp_port_max",
    udp_low: str = "udp_port_min",
    udp_high: str = "udp_port_max",
) -> Column:
    """Port or port range of a rule: UDP ports for UDP, TCP ports for all else."""
    return F.expr(
        f"""CASE WHEN {protocol} {_UDP} THEN {_range_label(udp_low, udp_high)}
                 ELSE {_range_label(tcp_low, tcp_high)} END"""
    )


def vcn_name(domain: str = "domain_name", pattern: str = K.VCN_NAME_PATTERN) -> Column:
    """First group of ``pattern`` in a subnet's domain name, NULL without a match."""
    return F.nullif(F.regexp_extract(domain, pattern, 1), F.lit(""))
