"""Registered queries: every report and every building block, on the testbed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter.functions import scalars
from perimeter.operators import attachments, exposure, lookup, rules, scope, services
from perimeter.plans import reports
from perimeter.plans.cleanup_ledger import KINDS as POLICIES
from perimeter.plans.cleanup_ledger import CleanupLedger
from perimeter.plans.colocated import Colocated
from perimeter.plans.lattice import KINDS
from perimeter.plans.regional_summary import RegionalSummary
from perimeter.sources import audit, batches, children, documents, downloads, loading, regions
from perimeter.testbed.workspace import (
    EXPOSURE,
    FAILED_REGION,
    LOOKUP_PRIVATE_IP,
    LOOKUP_PUBLIC_IP,
    LOOKUP_VNIC,
    MISSING_REGION,
    ON_SUBNETS,
    ON_VNICS,
    REGIONS,
    TENANCY,
    Workspace,
    workspace,
)

Query = Callable[[SparkSession, str], DataFrame]
SCOPES = {"pub": scope.PUBLIC, "priv": scope.PRIVATE}


def _query(build: Callable[[Workspace], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(workspace(spark, sf_dir))


def _on(build, *names: str) -> Query:
    """A query on the inventory; collections that it reads together are named."""
    return _query(lambda w: build(w.loaded(*names)))


_LOOKUP = ("vnics", "subnets", "securitylists", "nsgvnic", "nsgrules", "nsgdata")
_ADDRESSES = ("privateips", "publicips")


def _read_by(report: str) -> tuple[str, ...]:
    return {"sl": ON_SUBNETS, "nsg": ON_VNICS}.get(report.split("_")[-1], EXPOSURE)


def _reports() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for prefix, name in SCOPES.items():
        for key, report in reports.SCOPED_REPORTS.items():
            found[f"{prefix}_{key}"] = _on(lambda i, r=report, s=name: r(i, s), *_read_by(key))
    found["unused_sl"] = _on(reports.unused_sl, "securitylists", "subnets")
    found["unused_nsg"] = _on(reports.unused_nsg, "nsgdata", "nsgvnic", "nsgrules")
    found["lookup_vnic"] = _on(lambda i: reports.lookup_vnic(i, LOOKUP_VNIC), *_LOOKUP)
    by_ip = (*_LOOKUP, *_ADDRESSES)
    found["lookup_ip"] = _on(lambda i: reports.lookup_ip(i, LOOKUP_PRIVATE_IP), *by_ip)
    found["lookup_ip_public"] = _on(lambda i: reports.lookup_ip(i, LOOKUP_PUBLIC_IP), *by_ip)
    return found


def _subnets(inventory, name: str) -> DataFrame:
    return scope.scope_subnets(
        inventory.subnets, inventory.routes, name, scope.SUBNET, inventory.hot
    )


def _rules(inventory, policy: str, kind: str) -> DataFrame:
    rows = inventory.securitylists if policy == "sl" else inventory.nsgrules
    return getattr(rules, f"{policy}_{kind}_rules")(rows)


def _exposed(block: str, name: str, kind: str) -> Query:
    policy = block.split("_")[-1]

    def build(i) -> DataFrame:
        found = _rules(i, policy, kind)
        subnets = _subnets(i, name)
        operator = getattr(exposure, block)
        if block == "subnets_exposed_by_sl":
            return operator(i.subnets, subnets, found, i.hot)
        return operator(i.vnics, i.subnets if policy == "sl" else i.nsgvnic, subnets, found, i.hot)

    read = _read_by(block) if block != "vnics_exposed_by_sl" else (*ON_SUBNETS, "vnics")
    return _on(build, *read)


def _from_sl(i, name: str) -> DataFrame:
    return services.services_from_sl(i.subnets, i.securitylists, _subnets(i, name), i.hot)


def _from_nsg(i, name: str) -> DataFrame:
    return services.services_from_nsg(
        i.vnics, i.nsgvnic, i.nsgrules, _subnets(i, name), i.hot
    )


def _occurrences(services: DataFrame) -> DataFrame:
    """Services with how often they occur, instead of every rule at every attachment."""
    keys = [c for c in services.columns if c != "copies"]
    return services.groupBy(*keys).agg(F.sum("copies").alias("occurrences"))


def _policy_case(rows: DataFrame, policy: str) -> DataFrame:
    number = "rule_no" if policy == "securitylist_id" else "rule_id"
    return rows.select(policy, number, "insecure_case")


def _labels(i) -> DataFrame:
    group = rules.nsg_rules(i.nsgrules).select("rule_id", *rules.RULE_FIELDS)
    listed = rules.sl_rules(i.securitylists).select(
        F.concat_ws("-", "securitylist_id", F.col("rule_no").cast("string")).alias("rule_id"),
        *rules.RULE_FIELDS,
    )
    both = group.unionByName(listed)
    return both.select(
        "rule_id",
        scalars.protocol_label().alias("protocol_label"),
        scalars.protocol_label(upper_all=True).alias("protocol_label_upper"),
        scalars.service_label().alias("service_label"),
    )


def _blocks() -> dict[str, Query]:
    found = {
        "igw_route_tables": _on(lambda i: scope.igw_route_tables(i.routes)),
        "public_subnets": _on(lambda i: scope.public_subnets(i.subnets, i.routes, i.hot), "subnets", "routes"),
        "private_subnets": _on(lambda i: scope.private_subnets(i.subnets, i.routes, i.hot), "subnets", "routes"),
        "subnet_sl": _on(lambda i: attachments.subnet_sl(i.subnets)),
        "sl_rules": _on(lambda i: rules.sl_rules(i.securitylists)),
        "sl_open_rules": _on(lambda i: rules.sl_open_rules(i.securitylists)),
        "sl_insecure_rules": _on(lambda i: rules.sl_insecure_rules(i.securitylists)),
        "sl_insecure_cases": _on(
            lambda i: _policy_case(rules.sl_rule_cases(i.securitylists), "securitylist_id")
        ),
        "sl_insecure_ids": _on(
            lambda i: rules.sl_insecure_ids(i.securitylists).distinct()
        ),
        "sl_other_rules": _on(lambda i: rules.sl_other_rules(i.securitylists)),
        "nsg_rules": _on(lambda i: rules.nsg_rules(i.nsgrules)),
        "nsg_open_rules": _on(lambda i: rules.nsg_open_rules(i.nsgrules)),
        "nsg_insecure_rules": _on(lambda i: rules.nsg_insecure_rules(i.nsgrules)),
        "nsg_insecure_cases": _on(
            lambda i: _policy_case(rules.nsg_rule_cases(i.nsgrules), "nsg_id")
        ),
        "nsg_insecure_ids": _on(
            lambda i: rules.nsg_insecure_rules(i.nsgrules).select("nsg_id").distinct()
        ),
        "nsg_other_rules": _on(lambda i: rules.nsg_other_rules(i.nsgrules)),
        "sl_other_ids": _on(
            lambda i: rules.sl_other_ids(i.securitylists).distinct()
        ),
        "nsg_other_ids": _on(
            lambda i: rules.nsg_other_rules(i.nsgrules).select("nsg_id").distinct()
        ),
        "nsg_insecure_flags": _on(lambda i: rules.nsg_insecure_flags(i.nsgrules)),
        "rule_labels": _on(_labels, "nsgrules", "securitylists"),
        "nsg_vnic_assoc": _on(lambda i: attachments.nsg_vnic_assoc(i.nsgvnic)),
        "vnic_data": _on(lambda i: attachments.vnic_data(i.vnics)),
        "used_securitylists": _on(lambda i: attachments.used_securitylists(i.subnets)),
        "used_nsgs": _on(lambda i: attachments.used_nsgs(i.nsgvnic)),
        "sl_details": _on(lambda i: attachments.sl_details(i.securitylists)),
        "nsg_details": _on(lambda i: attachments.nsg_details(i.nsgdata)),
        "nsg_data": _on(lambda i: attachments.nsg_data(i.nsgdata)),
        "subnet_details": _on(lambda i: attachments.subnet_details(i.subnets)),
        "sl_insecure_agg": _on(lambda i: rules.sl_insecure_agg(i.securitylists)),
        "nsg_insecure_agg": _on(lambda i: rules.nsg_insecure_agg(i.nsgrules)),
        "ip_to_vnic": _on(
            lambda i: lookup.ip_to_vnic(i.privateips, i.publicips, LOOKUP_PRIVATE_IP, i.hot),
            *_ADDRESSES,
        ),
        "ip_to_vnic_public": _on(
            lambda i: lookup.ip_to_vnic(i.privateips, i.publicips, LOOKUP_PUBLIC_IP, i.hot),
            *_ADDRESSES,
        ),
        "vnic_target": _on(lambda i: lookup.vnic_target(i.vnics, LOOKUP_VNIC)),
        "vnic_target_by_ip": _on(lambda i: lookup.vnic_target_by_ip(i, LOOKUP_PRIVATE_IP), "vnics", *_ADDRESSES),
    }
    for prefix, name in SCOPES.items():
        for kind in ("insecure", "other"):
            for block in (
                "vnics_exposed_by_sl",
                "vnics_exposed_by_nsg",
                "subnets_exposed_by_sl",
                "subnets_exposed_by_nsg",
            ):
                found[f"{prefix}_{kind}_{block}"] = _exposed(block, name, kind)
        found[f"{prefix}_services_from_sl"] = _on(
            lambda i, s=name: _occurrences(_from_sl(i, s)), *ON_SUBNETS
        )
        found[f"{prefix}_services_from_nsg"] = _on(
            lambda i, s=name: _occurrences(_from_nsg(i, s)), *ON_VNICS
        )
        found[f"{prefix}_all_services"] = _on(
            lambda i, s=name: _occurrences(_from_sl(i, s).unionByName(_from_nsg(i, s))), *EXPOSURE
        )
    return found


def _document_id(name: str):
    fields = {
        "nsgrules": ("id",),
        "nsgvnic": ("`nsg-id`", "vnic_id"),
        "publicips": ("id",),
        "privateips": ("coalesce(id, identifier)",),
        "nsgdata": ("coalesce(identifier, id)",),
    }.get(name, ("identifier",))
    return F.concat_ws("/", *(F.expr(f) for f in fields)).alias("document_id")


def _document_ids(collections: dict[str, DataFrame], *columns: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        (
            rows.select(F.lit(name).alias("collection"), *columns, _document_id(name))
            for name, rows in collections.items()
        ),
    )


def _selected(w: Workspace) -> DataFrame:
    chosen = regions.consolidate_regions(
        w.spark, w.export_dir, TENANCY, " region-1,region-3 ,, region-4", skip="region-4"
    )
    return _document_ids(chosen, "region").groupBy("collection", "region").agg(
        F.count(F.lit(1)).alias("documents")
    )


def _exported(w: Workspace, *names: str) -> dict[str, DataFrame]:
    """These collections of the exports, whole; the others are neither written nor read for them."""
    return regions.consolidate_regions(w.spark, w.exports(*names), TENANCY, collections=names)


def _tagged(w: Workspace) -> DataFrame:
    """Private addresses as listed per subnet, tagged with where they were listed."""
    listed = _exported(w, "privateips")["privateips"].withColumns(
        {"_region": F.col("region"), "_subnet": F.col("`subnet-id`")}
    )
    tagged = children.tag_parent(
        listed.drop("region", "subnet-id"), region=F.col("_region"), subnet_id=F.col("_subnet")
    )
    return tagged.select(
        F.expr("coalesce(id, identifier)").alias("child_id"),
        "region",
        F.col("`subnet-id`").alias("parent_id"),
    )


def _public_ip_ids(w: Workspace) -> DataFrame:
    """Search hits, one per line item: repeated, and empty or missing where nothing was found."""
    line_items = w.spark.read.parquet(f"{w.sf_dir}/lineitem.parquet")
    found = F.concat(F.lit("pub-"), F.col("l_orderkey").cast("string"))
    hit = F.when(F.col("l_linestatus") == "O", found).when(F.col("l_returnflag") == "A", "")
    return children.dedupe_public_ip_ids(line_items.select(hit.alias("identifier")))


def _subnet_ids(w: Workspace) -> DataFrame:
    """Subnets of every order: each subnet many times."""
    exported = _exported(w, "privateips", "subnets")
    listed = exported["privateips"].select(F.col("`subnet-id`").alias("identifier"))
    return children.dedupe_subnet_ids(
        exported["subnets"].select("identifier").unionByName(listed)
    )


def _rule_lines(lines: DataFrame) -> DataFrame:
    line = F.col("value")
    return lines.select(
        F.get_json_object(line, "$.id").alias("rule_id"),
        line.contains('"tcp_options":null').alias("tcp_options_null"),
        line.contains('"udp_options":null').alias("udp_options_null"),
    )


def _written(w: Workspace) -> DataFrame:
    """Group rules written as JSON lines, read back as text."""
    path = w.new_path()
    documents.write_jsonl(_exported(w, "nsgrules")["nsgrules"], path, compression="gzip")
    return _rule_lines(w.spark.read.text(path))


def _appended(w: Workspace) -> DataFrame:
    """Group rules appended in two batches, each of them twice."""
    path = w.new_path()
    rows = _exported(w, "nsgrules")["nsgrules"]
    first = F.col("region").isin(*REGIONS[:2])
    for batch, chosen in (("first", first), ("first", first), ("rest", ~first), ("rest", ~first)):
        batches.append_batch(rows.where(chosen), path, batch, compression="gzip")
    return _rule_lines(w.spark.read.text(batches.batch_paths(w.spark, path)))


def _loaded(w: Workspace) -> DataFrame:
    """What was counted while the tables were loaded."""
    return loading.loaded_audit(w.inventory.routes.sparkSession, w.tables_dir)


def _regional_summary(w: Workspace) -> DataFrame:
    """Both summaries from counts kept per region; one region is counted twice.

    Group attachments lie in their rule's region here, not in that of their interface.
    """
    kept = RegionalSummary(w.spark, w.new_path(), whole=("nsgvnic",))
    for region in (*REGIONS, REGIONS[1]):
        kept.replace(w.inventory, region)
    rows = [
        kept.summary(name, ordered=False).select(F.lit(prefix).alias("scope"), "*")
        for prefix, name in SCOPES.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# The tables that say which policies there are and where they are attached.
_POLICY_TABLES = ("securitylists", "subnets", "nsgdata", "nsgrules", "nsgvnic")


def _in_two_exports(w: Workspace, first, found) -> DataFrame:
    """Both cleanup ledgers after the export ``first`` and that of all tables."""
    whole = w.only(*_POLICY_TABLES)
    path, rows = w.new_path(), []
    for name, kind in POLICIES.items():
        ledger = CleanupLedger(w.spark, path, name)
        ledger.take(replace(whole, **first(whole)), "first")
        ledger.take(whole, "all")
        named = found(ledger).withColumnsRenamed({kind.name: "name", kind.policy: "policy"})
        rows.append(named.select(F.lit(name).alias("kind"), "*"))
    return reduce(DataFrame.unionByName, rows)


def _unused_by_ledger(w: Workspace) -> DataFrame:
    """Both cleanup reports; the first export lacks a region."""

    def first(whole) -> dict[str, DataFrame]:
        return {n: t.where(F.col("region") != REGIONS[1]) for n, t in whole.tables().items()}

    return _in_two_exports(w, first, lambda ledger: ledger.unused(ordered=False))


def _unused_no_more(w: Workspace) -> DataFrame:
    """What left both cleanup reports when policies were attached; the first export has no attachments."""

    def bare(whole) -> dict[str, DataFrame]:
        return {"subnets": whole.subnets.where("false"), "nsgvnic": whole.nsgvnic.where("false")}

    return _in_two_exports(w, bare, lambda ledger: ledger.changes("all"))


def _downloaded(w: Workspace) -> DataFrame:
    """A report saved as CSV and read back."""
    path = w.new_path()
    report = reports.other_subnets(w.loaded(*EXPOSURE), scope.PRIVATE)
    downloads.write_report(report, path, "csv")
    return w.spark.read.schema(report.schema).csv(path, header=True, escape='"')


def _from_lattice(table: str) -> Query:
    """The four reports on interfaces or on subnets, told apart by their names."""

    def build(w: Workspace) -> DataFrame:
        report = {"vnics": w.lattice.exposed_vnics, "subnets": w.lattice.exposed_subnets}[table]
        rows = [
            report(name, kind, ordered=False).select(F.lit(f"{prefix}_{kind}_{table}").alias("report"), "*")
            for prefix, name in SCOPES.items()
            for kind in KINDS
        ]
        return reduce(DataFrame.unionByName, rows)

    return _query(build)


def _lattice() -> dict[str, Query]:
    return {f"lattice_{table}": _from_lattice(table) for table in ("vnics", "subnets")}


def _colocated(kind: str) -> Query:
    """The group rules of both scopes, from interfaces and members that lie together."""

    def build(w: Workspace) -> DataFrame:
        stored = Colocated.store(w.loaded(*ON_VNICS), w.new_path())
        report = {"insecure": stored.insecure_nsg, "other": stored.other_nsg}[kind]
        rows = [report(name, ordered=False).select(F.lit(prefix).alias("scope"), "*") for prefix, name in SCOPES.items()]
        return reduce(DataFrame.unionByName, rows)

    return _query(build)


def _sources() -> dict[str, Query]:
    expected = (*REGIONS, MISSING_REGION)
    return {
        "load_collections": _query(
            lambda w: _document_ids(documents.load_collections(w.spark, w.consolidated_dir))
        ),
        "consolidate_regions": _query(
            lambda w: _document_ids(
                regions.consolidate_regions(w.spark, w.export_dir, TENANCY), "region"
            )
        ),
        "select_regions": _query(_selected),
        "tag_parent": _query(_tagged),
        "dedupe_public_ip_ids": _query(_public_ip_ids),
        "dedupe_subnet_ids": _query(_subnet_ids),
        "collection_counts": _query(
            lambda w: audit.collection_counts(
                w.spark, w.export_dir, TENANCY, expected, [FAILED_REGION]
            )
        ),
        "load_audit": _query(
            lambda w: audit.load_audit(w.spark, w.export_dir, TENANCY, expected, [FAILED_REGION])
        ),
        "loaded_audit": _query(_loaded),
        "write_jsonl": _query(_written),
        "append_batches": _query(_appended),
        "regional_summary": _query(_regional_summary),
        "cleanup_ledger": _query(_unused_by_ledger),
        "cleanup_changes": _query(_unused_no_more),
        "write_report": _query(_downloaded),
    }


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    colocated = {f"colocated_{kind}_nsg": _colocated(kind) for kind in KINDS}
    return {**_reports(), **_blocks(), **_lattice(), **colocated, **_sources()}


def report_keys() -> list[str]:
    """Names of the user-level reports."""
    return list(_reports())
