"""Documents of the nine collections, derived from the given tables.

The mapping is the one of FIXTURES.md: every base row becomes a document, a
rule or an attachment. Divisors and remainders only decide which kind of rule
or field spelling a row becomes, so that all cases of the reports occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

LINE_ORDER = (
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_shipdate",
)


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _region(number: Column) -> Column:
    return _id("region-", number)


class Tables:
    """The base tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        def read(name: str) -> DataFrame:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")

        self.nation = read("nation")
        self.customer = read("customer").join(
            self.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"),
            "c_nationkey",
            "left",
        )
        self.part = read("part")
        self.orders = read("orders").join(
            self.customer.select(F.col("c_custkey").alias("o_custkey"), "n_regionkey"),
            "o_custkey",
            "left",
        )
        self.lineitem = read("lineitem")

    def rules(self) -> DataFrame:
        """Line items as firewall rules, numbered within their order."""
        kind = F.expr("(l_suppkey + l_linenumber) % 6")
        number = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
        first_half = F.col("l_linestatus") == "F"
        quantity = F.col("l_quantity").cast("bigint")
        tcp = F.when(kind == 2, quantity + F.when(first_half, 0).otherwise(3360))
        width = F.expr("l_partkey % 3") * F.when(first_half, 10).otherwise(15)
        udp = F.when((kind == 3) & (F.col("l_linenumber") != 7), quantity + 500)
        return self.lineitem.select(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            "l_discount",
            number.cast("bigint").alias("rn"),
            F.when(F.col("l_returnflag") == "R", "10.0.0.0/8")
            .otherwise("0.0.0.0/0")
            .alias("source"),
            F.when(kind == 0, "all")
            .when(kind == 3, "17")
            .when(kind == 4, "1")
            .otherwise("6")
            .alias("protocol"),
            kind.isin(2, 5).alias("has_tcp"),
            tcp.alias("tcp_min"),
            (tcp + width).alias("tcp_max"),
            udp.alias("udp_min"),
            (udp + F.expr("l_partkey % 2")).alias("udp_max"),
        )


def _ports(present: Column, low: Column, high: Column, range_field: str) -> Column:
    port_range = F.when(low.isNotNull(), F.struct(low.alias("min"), high.alias("max")))
    return F.when(present, F.struct(port_range.alias(range_field)))


def _rule_options(range_field: str) -> tuple[Column, Column]:
    tcp = _ports(F.col("has_tcp"), F.col("tcp_min"), F.col("tcp_max"), range_field)
    has_udp = F.col("udp_min").isNotNull()
    return tcp, _ports(has_udp, F.col("udp_min"), F.col("udp_max"), range_field)


def _routes(t: Tables) -> DataFrame:
    gateway = F.when(F.col("n_regionkey").isin(0, 1, 3), "internetgateway-").otherwise(
        "natgateway-"
    )
    target = F.concat(gateway, F.col("n_nationkey").cast("string"))
    return t.nation.select(
        _region(F.col("n_regionkey")).alias("region"),
        F.struct(
            _id("rt-", F.col("n_nationkey")).alias("identifier"),
            F.struct(F.array(F.struct(target.alias("networkEntityId"))).alias("routeRules")).alias(
                "additional_details"
            ),
        ).alias("document"),
    )


def _subnets(t: Tables) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    lists = (
        t.orders.where(F.col("o_orderstatus") == "F")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sort_array(F.collect_list(_id("sl-", F.col("o_orderkey")))).alias("lists"))
    )
    flag = F.when(segment == "BUILDING", True).when(segment != "MACHINERY", False)
    domain = F.when(
        F.expr("c_custkey % 7 <> 0"),
        F.concat(_id("s", key), _id(".vcn", F.col("c_nationkey")), F.lit(".oraclevcn.com")),
    )
    return t.customer.join(lists, "c_custkey", "left").select(
        _region(F.col("n_regionkey")).alias("region"),
        F.struct(
            _id("subnet-", key).alias("identifier"),
            F.col("c_name").alias("display_name"),
            F.struct(
                _id("rt-", F.col("c_nationkey")).alias("routeTableId"),
                flag.alias("prohibitPublicIpOnVnic"),
                F.col("lists").alias("securityListIds"),
                _id("vcn-", F.col("c_nationkey")).alias("vcnId"),
                domain.alias("subnetDomainName"),
            ).alias("additional_details"),
        ).alias("document"),
    )


def _securitylists(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    tcp, udp = _rule_options("destinationPortRange")
    rule = F.struct(
        "rn", "source", "protocol", tcp.alias("tcpOptions"), udp.alias("udpOptions")
    )
    rules = (
        t.rules()
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sort_array(F.collect_list(rule)).alias("rules"))
    )
    return t.orders.join(rules, "o_orderkey", "left").select(
        _region(F.col("n_regionkey")).alias("region"),
        F.struct(
            _id("sl-", key).alias("identifier"),
            _id("sl-name-", key).alias("display_name"),
            _id("comp-", F.expr("o_custkey % 10")).alias("compartment_id"),
            F.lit("AVAILABLE").alias("lifecycle_state"),
            F.col("o_orderdate").cast("date").cast("string").alias("time_created"),
            F.struct(
                _id("vcn-", F.expr("o_custkey % 25")).alias("vcnId"),
                F.transform("rules", lambda r: r.dropFields("rn")).alias("ingressSecurityRules"),
            ).alias("additional_details"),
        ).alias("document"),
    )


def _private_ip() -> Column:
    return F.expr("concat('10.0.', (o_orderkey % 5000) div 250, '.', o_orderkey % 250 + 1)")


def _public_ip() -> Column:
    return F.expr(
        "concat('198.', 18 + o_orderkey div 62500, '.', (o_orderkey div 250) % 250, '.',"
        " o_orderkey % 250 + 1)"
    )


def _vnics(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        _region(F.col("n_regionkey")).alias("region"),
        F.struct(
            _id("vnic-", key).alias("identifier"),
            _id("vnic-name-", key).alias("display_name"),
            F.struct(
                _id("subnet-", F.col("o_custkey")).alias("subnetId"),
                _private_ip().alias("privateIp"),
                F.when(F.col("o_orderstatus") == "O", _public_ip()).alias("publicIp"),
            ).alias("additional_details"),
        ).alias("document"),
    )


def _nsgdata(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    as_id = F.expr("p_partkey % 5 = 0")
    nsg = _id("nsg-", key)
    return t.part.select(
        _region(F.expr("p_partkey % 5")).alias("region"),
        F.struct(
            F.when(~as_id, nsg).alias("identifier"),
            F.when(as_id, nsg).alias("id"),
            F.when(F.expr("p_partkey % 11 <> 0"), _id("nsg-name-", key)).alias("display_name"),
            _id("comp-", F.expr("p_partkey % 10")).alias("compartment_id"),
            F.lit("AVAILABLE").alias("lifecycle_state"),
            F.concat(F.lit("2020-01-"), F.lpad(F.expr("p_size % 28 + 1"), 2, "0")).alias(
                "time_created"
            ),
            F.struct(_id("vcn-", F.expr("p_partkey % 25")).alias("vcnId")).alias(
                "additional_details"
            ),
        ).alias("document"),
    )


def _nsgrules(t: Tables) -> DataFrame:
    tcp, udp = _rule_options("destination_port_range")
    region = _region(F.expr("l_partkey % 5"))
    return (
        t.rules().select(
            region.alias("region"),
            F.struct(
                _id("nsg-", F.col("l_partkey")).alias("nsg-id"),
                region.alias("region"),
                F.expr("concat('rule-', l_orderkey, '-', rn)").alias("id"),
                F.when(F.col("l_discount") < 0.02, "EGRESS")
                .otherwise("INGRESS")
                .alias("direction"),
                "source",
                "protocol",
                tcp.alias("tcp_options"),
                udp.alias("udp_options"),
            ).alias("document"),
        )
    )


def _nsgvnic(t: Tables) -> DataFrame:
    small = t.part.where(F.col("p_size") <= 40).select(F.col("p_partkey").alias("l_partkey"))
    region = _region(F.expr("l_partkey % 5"))
    return (
        t.lineitem.join(small, "l_partkey", "left_semi")
        .select(
            region.alias("region"),
            F.struct(
                _id("nsg-", F.col("l_partkey")).alias("nsg-id"),
                _id("vnic-", F.col("l_orderkey")).alias("vnic_id"),
                region.alias("region"),
            ).alias("document"),
        )
    )


def _privateips(t: Tables) -> DataFrame:
    def when(remainder: str, value: Column) -> Column:
        return F.when(F.expr(f"o_orderkey % {remainder}"), value)

    pip, vnic = _id("pip-", F.col("o_orderkey")), _id("vnic-", F.col("o_orderkey"))
    region = _region(F.col("n_regionkey"))
    return t.orders.select(
        region.alias("region"),
        F.struct(
            when("8 <> 0", pip).alias("id"),
            when("8 = 0", pip).alias("identifier"),
            when("3 = 0", vnic).alias("vnic_id"),
            when("3 = 1", vnic).alias("vnic-id"),
            when("3 = 2", vnic).alias("vnicId"),
            when("4 = 0", _private_ip()).alias("ip_address"),
            when("4 <> 0", _private_ip()).alias("ipAddress"),
            region.alias("region"),
            _id("subnet-", F.col("o_custkey")).alias("subnet-id"),
        ).alias("document"),
    )


def _publicips(t: Tables) -> DataFrame:
    key, pip = F.col("o_orderkey"), _id("pip-", F.col("o_orderkey"))
    region = _region(F.col("n_regionkey"))
    return t.orders.where(F.col("o_orderstatus") == "O").select(
        region.alias("region"),
        F.struct(
            _id("pub-", key).alias("id"),
            F.when(F.expr("o_orderkey % 2 = 0"), _public_ip()).alias("ip_address"),
            F.when(F.expr("o_orderkey % 2 <> 0"), _public_ip()).alias("ipAddress"),
            F.when(F.expr("o_orderkey % 3 <> 0"), pip).alias("private_ip_id"),
            F.when(F.expr("o_orderkey % 3 = 0"), pip).alias("privateIpId"),
            region.alias("region"),
        ).alias("document"),
    )


def documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """(region, document) rows of every collection."""
    t = Tables(spark, sf_dir)
    return {
        "nsgdata": _nsgdata(t),
        "nsgrules": _nsgrules(t),
        "nsgvnic": _nsgvnic(t),
        "securitylists": _securitylists(t),
        "publicips": _publicips(t),
        "privateips": _privateips(t),
        "subnets": _subnets(t),
        "vnics": _vnics(t),
        "routes": _routes(t),
    }


def json_lines(collection: str, rows: DataFrame) -> DataFrame:
    """(region, value) lines; group rules keep absent options as explicit nulls."""
    keep_nulls = {"ignoreNullFields": "false"} if collection == "nsgrules" else {}
    return rows.select("region", F.to_json("document", keep_nulls).alias("value"))


def broken_lines(vnic_lines: DataFrame) -> DataFrame:
    """Cut copies of the lines of every 100th order: audit input, not documents."""
    every_100th = F.col("value").like('%"identifier":"vnic-%00","display_name"%')
    return vnic_lines.where(every_100th).select(
        "region", F.expr("substring(value, 1, length(value) - 3)").alias("value")
    )


def with_trailing_text(lines: DataFrame) -> DataFrame:
    """Public addresses of every 100th order get a second document on their line: audit input."""
    every_100th = F.col("value").rlike('"id":"pub-[0-9]*00",')
    doubled = F.concat("value", F.lit(' {"id":"second"}'))
    return lines.withColumn("value", F.when(every_100th, doubled).otherwise(F.col("value")))
