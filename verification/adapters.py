"""Source tables of the plans, derived row by row from the given tables.

The given tables hold no nulls, so the adapters make some from column values.
Every adapter reads its whole table. Each is stated once as column texts that
Spark and DuckDB both read; nested values are put together per engine from
those texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def duck_struct(fields: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"


def spark_map(entries: dict[str, str]) -> str:
    return "map(" + ", ".join(f"'{k}', {v}" for k, v in entries.items()) + ")"


def duck_map(entries: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': {v}" for k, v in entries.items()) + "}"


def spark_array(items: list[str]) -> str:
    return f"array({', '.join(items)})"


def duck_array(items: list[str]) -> str:
    return f"[{', '.join(items)}]"


DIALECTS = {
    "spark": (spark_struct, spark_map, spark_array),
    "duck": (duck_struct, duck_map, duck_array),
}


def select_list(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{text} AS {name}" for name, text in columns.items())


def derive(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str]) -> DataFrame:
    """A table's columns by their texts."""
    return table(spark, sf_dir, name).select(*[F.expr(text).alias(out) for out, text in columns.items()])


# --- readings and series -------------------------------------------------------------------

# User 0 is not signed in: no tag. Values below 1 carry no quality.
READINGS = {
    "tag_id": "CASE WHEN user_id <> 0 THEN concat('u', CAST(user_id AS string), '.', event_type) END",
    "data_quality": "CASE WHEN value < 1 THEN NULL WHEN value < 5 THEN 0 WHEN value < 50 THEN 1 ELSE 3 END",
    "event_time": "ts",
    "event_value": "value",
    "event_id": "event_id",
}

DAILY = {
    "tag_id": "concat('o', CAST(l_orderkey AS string))",
    "latest_time": "l_shipdate",
    "daily_value": "l_quantity",
}

# One entry per order, null for orders still pending.
DAILY_TAGS = {
    "tag_id": "CASE WHEN o_orderstatus <> 'P' THEN concat('o', CAST(o_orderkey AS string)) END"
}

HOURLY = {
    "tag_id": "concat('u', CAST(user_id AS string))",
    "latest_time": "ts",
    "hourly_value": "value",
}

# A customer occurs once per order, so the list repeats tags; null when not urgent.
HOURLY_TAGS = {
    "tag_id": "CASE WHEN o_orderpriority = '1-URGENT' THEN concat('u', CAST(o_custkey AS string)) END"
}

# --- audit events --------------------------------------------------------------------------

AUDIT = {
    "suid": "concat('s', CAST(user_id AS string))",
    "eventtime": "ts",
    "eventtype": "CASE WHEN event_type <> 'error' THEN event_type END",
    "cartid": "CASE WHEN event_type = 'purchase' THEN concat('g', CAST(event_id AS string)) END",
    "gtoken": "CASE WHEN value >= 1 THEN props END",
    "city": "CASE WHEN user_id <> 0 THEN CAST(user_id AS int) END",
    "region": "CASE WHEN value < 100 THEN CAST(floor(value) AS int) END",
    "country": "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END",
    "activeleid": "CASE WHEN event_type = 'signup' THEN 'first' END",
    "notifurl": "CASE WHEN event_type = 'click' THEN concat('/n/', CAST(event_id AS string)) END",
    "notif_audit_id": "CASE WHEN value > 20 THEN concat('a', CAST(event_id AS string)) END",
}

# --- cohorts -------------------------------------------------------------------------------


def cohort_source(dialect: str) -> dict[str, str]:
    """Cohort launch rows, one per order; ``is_active_flag`` is null for pending orders."""
    _, make_map, make_array = DIALECTS[dialect]
    return {
        "suid": "CASE WHEN o_custkey <> 3 THEN concat('s', CAST(o_custkey AS string)) END",
        "serial_number": "concat('n', CAST(o_orderkey AS string))",
        "cohort_id": "concat('k', CAST(o_orderkey AS string))",
        "country_code": "substr(o_orderpriority, 1, 1)",
        "country_name": "o_orderpriority",
        "exploit_id": make_array(["o_orderstatus", "substr(o_orderpriority, 3)"]),
        "product_leid": f"CASE WHEN o_totalprice > 20000 THEN {make_array(['o_orderpriority'])} END",
        "is_binary_modified": make_map(
            {"host": "o_totalprice > 200000", "file": "o_orderstatus = 'F'"}
        ),
        "non_genuine_leids": f"CASE WHEN o_orderstatus = 'O' THEN {make_array(['o_orderstatus'])} END",
        "is_hostfile_modified": "CASE WHEN o_totalprice > 50000 THEN o_totalprice > 300000 END",
        "is_deleted": "CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice < 1000 END",
        "update_date": "o_orderdate",
        "external_campaign": "CASE WHEN o_orderstatus = 'F' THEN 'autumn' END",
        "targeting_process": "'weekly'",
        "launch_date": "CAST(CAST(o_orderdate AS date) AS string)",
        "target_category": "o_orderstatus",
        "target_detarget_reason": "CASE WHEN o_totalprice < 5000 THEN 'small' END",
        "inapp_checkout_enabled": "o_orderpriority = '1-URGENT'",
        "is_active_flag": "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice > 2000 END",
    }


def cohort_target_source(dialect: str) -> dict[str, str]:
    """The state the target was last synced from: urgent orders unknown, high ones launched later."""
    return {
        **cohort_source(dialect),
        "launch_date": "CASE WHEN o_orderpriority = '2-HIGH' THEN '1992-01-01' "
        "ELSE CAST(CAST(o_orderdate AS date) AS string) END",
        "is_active_flag": "o_orderpriority <> '1-URGENT'",
    }


def disabled_source(dialect: str) -> dict[str, str]:
    """Cohort definitions, one per order; null flags are dropped or read as false."""
    source = cohort_source(dialect)
    return {
        "suid": "concat('s', CAST(o_custkey AS string))",
        "serialnumber": source["serial_number"],
        "cohortid": source["cohort_id"],
        "exploitid": source["non_genuine_leids"],
        "leids": source["product_leid"],
        "binarymod": source["is_binary_modified"],
        "hostfilemod": source["is_hostfile_modified"],
        "disabled": "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority > '3' END",
        "isdeleted": source["is_deleted"],
        "externalcampaign": source["external_campaign"],
        "lastupdatetime": "o_orderdate",
    }


# --- machines ------------------------------------------------------------------------------

KEY = "concat(CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string))"

LICENSE = {
    "serialnumber": f"concat('n', {KEY})",
    "dateadded": "l_shipdate - INTERVAL 30 DAY",
    "lastchecked": "CASE WHEN l_tax > 0.02 THEN l_shipdate END",
    "licensetype": "CAST(l_linenumber AS int)",
    "licenseduration": "CAST(l_quantity AS bigint)",
    "licenseremaining": "CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS bigint) - 10 END",
    "licensestarttime": "CAST(l_partkey AS bigint)",
    "licensepguid": "CAST(l_suppkey AS string)",
    "snlocale": "'en'",
    "snplatform": "l_linestatus",
    "sntype": "l_returnflag",
    "licenseexceptiontype": "CASE WHEN l_returnflag = 'R' THEN 'returned' END",
    "licensingleid": "concat('leid-', CAST(l_partkey AS string))",
    "productleid": "concat('leid-', CAST(l_suppkey AS string))",
    "missingfromlastdata": "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END",
    "detectedlicensetype": "l_linestatus",
    "hastrialoverride": "l_discount > 0.05",
    "ownerguid": "CAST(l_orderkey AS string)",
    "pguid_anon": "CAST(l_partkey AS string)",
}

RELATIONSHIP = {
    "licenseid": f"concat('n', {KEY})",
    "licenseexpirytimestamp": "l_shipdate + INTERVAL 365 DAY",
    "appentitlementstatus": "l_returnflag",
    "activationmode": "l_linestatus",
    "billingstatus": "CASE WHEN l_discount > 0 THEN 'reduced' END",
    "activelicense": "l_linestatus = 'O'",
}

FILE = {
    "name": "concat('f', CAST(l_partkey AS string))",
    "signed": "CASE WHEN l_tax > 0.01 THEN l_tax > 0.04 END",
    "failurereason": "CASE WHEN l_returnflag = 'A' THEN 'unsigned' END",
    "version": "CAST(l_linenumber AS string)",
    "checksum": "md5(CAST(l_partkey AS string))",
    "signerinfo": "l_linestatus",
}

CONFIG = {
    "id": "CAST(l_suppkey AS string)",
    "npd_id": "CAST(l_partkey AS string)",
    "ngl_app_id": "l_returnflag",
    "npd_precedence": "CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS int) END",
    "deployment_mode": "l_linestatus",
    "branding_name": "'plain'",
}


def profile(dialect: str) -> dict[str, str]:
    make_struct, _, make_array = DIALECTS[dialect]
    return {
        "relationshipprofile": make_array([make_struct(RELATIONSHIP)]),
        "userpguid": "CAST(l_suppkey AS string)",
        "usercountrycode": "l_linestatus",
        "deviceid": f"concat('d', {KEY})",
        "osuserid": "CAST(l_orderkey AS string)",
        "nglmode": "l_returnflag",
        "creationtime": "l_shipdate",
        "cachelifetime": "CAST(l_quantity AS bigint)",
        "pguid_anon": "CAST(l_partkey AS string)",
    }


def hardening(dialect: str) -> dict[str, str]:
    make_struct, make_map, make_array = DIALECTS[dialect]
    state = {
        "statename": "l_linestatus",
        "statevalueinfo": make_map({"flag": "l_returnflag", "line": "CAST(l_linenumber AS string)"}),
    }
    return {
        "appid": "CAST(l_partkey AS string)",
        "appexe": "'app.exe'",
        "appversion": "CAST(l_linenumber AS string)",
        "msgcreationtimestamp": "l_shipdate",
        "deviceid": f"concat('d', {KEY})",
        "machineguid": "CAST(l_orderkey AS string)",
        "contextguid": "CAST(l_suppkey AS string)",
        "appstate": make_array([make_struct(state)]),
    }


def product(dialect: str, leid: str, files: str, licenses: str, nglapp: str) -> dict[str, str]:
    _, make_map, make_array = DIALECTS[dialect]
    return {
        "leid": leid,
        "locale": "'en'",
        "installerid": "CAST(l_suppkey AS string)",
        "files": files,
        "lastrulefetched": "l_shipdate",
        "firstrulefetched": "l_shipdate - INTERVAL 10 DAY",
        "licenses": licenses,
        "invocationagents": make_map({"agent": "l_shipdate"}),
        "installationtime": "l_shipdate - INTERVAL 20 DAY",
        "nglapp": nglapp,
        "deploymentmode": "l_linestatus",
        "nglprofiles": make_map({"profile": "l_returnflag"}),
        "nglappid": "CAST(l_partkey AS string)",
        "nglappversion": "CAST(l_linenumber AS string)",
        "operatingconfigids": make_array(["CAST(l_suppkey AS string)"]),
    }


def products(dialect: str) -> str:
    """Three products per machine: with files, with licenses at times, with neither at times."""
    make_struct, make_map, make_array = DIALECTS[dialect]
    files = make_map({"main": make_struct(FILE)})
    licenses = make_array(["l_linestatus", "l_returnflag"])
    flag = "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END"
    return make_map(
        {
            "base": make_struct(product(dialect, "'base'", files, "NULL", flag)),
            "more": make_struct(
                product(
                    dialect,
                    "'more'",
                    f"CASE WHEN l_discount > 0.05 THEN {files} END",
                    f"CASE WHEN l_linestatus = 'O' THEN {licenses} END",
                    "l_tax > 0.04",
                )
            ),
            "idle": make_struct(
                product(
                    dialect,
                    "'idle'",
                    f"CASE WHEN l_quantity > 45 THEN {files} END",
                    "NULL",
                    "NULL",
                )
            ),
        }
    )


def machine_source(dialect: str) -> dict[str, str]:
    """Machine snapshots, one per line item."""
    make_struct, make_map, make_array = DIALECTS[dialect]
    update_info = {
        "agsservicestatus": "l_linestatus",
        "updatesuppressed": "CASE WHEN l_tax > 0.01 THEN l_tax > 0.05 END",
        "lastupdaterequeststatus": "l_returnflag",
        "lastupdateattempted": "l_shipdate",
    }
    return {
        "suid": f"concat('m', {KEY})",
        "guid": "CAST(l_partkey AS string)",
        "machineid": f"CASE WHEN l_discount > 0 THEN concat('id', {KEY}) END",
        "ngldeviceid": f"concat('d', {KEY})",
        "icclientreferenceid": "CAST(l_suppkey AS string)",
        "os": "CASE l_returnflag WHEN 'A' THEN 'WIN' WHEN 'N' THEN 'MAC' END",
        "osversion": "CAST(l_linenumber AS string)",
        "oslocale": "'en'",
        "gcclientversion": "l_linestatus",
        "gcupdaterversion": "l_returnflag",
        "lastupdatecheck": "CASE WHEN l_tax > 0 THEN l_shipdate END",
        "firstupdatecheck": "l_shipdate - INTERVAL 30 DAY",
        "lastrulefetched": "CASE WHEN l_tax > 0.02 THEN l_shipdate + INTERVAL 1 DAY END",
        "firstrulefetched": "l_shipdate - INTERVAL 29 DAY",
        "lastruleprocessed": "CASE WHEN l_tax > 0.04 THEN l_shipdate + INTERVAL 2 DAY END",
        "firstruleprocessed": "l_shipdate - INTERVAL 28 DAY",
        "firstdispatchfetched": "l_shipdate - INTERVAL 27 DAY",
        "lastdispatchfetched": "CASE WHEN l_tax > 0.06 THEN l_shipdate + INTERVAL 3 DAY END",
        "hostfileentries": f"CASE WHEN l_linestatus = 'F' THEN {make_array(['l_returnflag', 'l_linestatus'])} END",
        "country": "CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS int) END",
        "region": "CAST(l_quantity AS int)",
        "city": "CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey AS int) END",
        "ip": "concat('10.0.0.', CAST(l_linenumber AS string))",
        "domainname": "'example.org'",
        "organizationname": "CASE WHEN l_linestatus = 'O' THEN 'open' END",
        "thorinstalled": "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'A' END",
        "licenses": f"CASE WHEN l_quantity > 5 THEN {make_map({'one': make_struct(LICENSE)})} END",
        "nglprofiles": make_map({"user": make_struct(profile(dialect))}),
        "producthardeningappinfo": f"CASE WHEN l_returnflag = 'A' THEN {make_map({'app': make_struct(hardening(dialect))})} END",
        "leids": f"CASE WHEN l_quantity > 2 THEN {products(dialect)} END",
        "files": make_map({"a": make_struct(FILE), "b": make_struct({**FILE, "name": "'second'"})}),
        "operatingconfigs": f"CASE WHEN l_linestatus = 'O' THEN {make_map({'c': make_struct(CONFIG)})} END",
        "clientuninstalled": "CASE WHEN l_returnflag <> 'A' THEN l_returnflag = 'R' END",
        "clientuninstallreason": "CASE WHEN l_returnflag = 'R' THEN 'returned' END",
        "clientuninstalldate": "CASE WHEN l_returnflag = 'R' THEN l_shipdate + INTERVAL 5 DAY END",
        "markedforuninstall": "l_returnflag = 'R'",
        "clientsource": "l_linestatus",
        "lasttimeproductless": "CASE WHEN l_quantity > 40 THEN l_shipdate END",
        "uninstallruletype": "CASE WHEN l_returnflag = 'R' THEN 'rule' END",
        "invocationagents": make_map({"agent": "l_shipdate"}),
        "cartids": f"CASE WHEN l_quantity > 25 THEN {make_map({'cart': 'CAST(l_orderkey AS string)'})} END",
        "ipaddresses": make_array(["concat('10.0.0.', CAST(l_linenumber AS string))"]),
        "dnsdomainname": "'example.org'",
        "dnshostname": f"concat('h', {KEY})",
        "workgroup": "l_returnflag",
        "clientupdateinfo": f"CASE WHEN l_linenumber > 2 THEN {make_struct(update_info)} END",
        "systemmanufacturer": "CAST(l_suppkey AS string)",
        "systemmodel": "CAST(l_partkey AS string)",
        "ipbelongstoisp": "CASE WHEN l_tax > 0.03 THEN true END",
        "ispname": "CASE WHEN l_tax > 0.03 THEN 'isp' END",
        "homebusinesstype": "CASE WHEN l_quantity > 30 THEN 'business' ELSE 'home' END",
    }
