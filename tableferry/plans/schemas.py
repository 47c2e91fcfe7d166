"""Column names, types and order of the tables the plans read and write.

They are stated as Spark DDL because results must carry exactly these columns.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

READINGS = "tag_id string, data_quality int, event_time timestamp, event_value double"

TAGS = "tag_id string"

AUDIT_EVENTS = """
    suid string, event_time string, event_type string, gid string, gtoken string,
    city int, state int, country int, notifiedleid string, notifurl string, notifauditid string
"""

DISABLED_COHORTS = """
    suid string, serialnumber string, cohortid string, exploitid array<string>,
    leids array<string>, binarymod map<string,boolean>, hostfilemod boolean, disabled boolean,
    isdeleted boolean, externalcampaign string, lastupdatetime timestamp
"""

COHORT_TARGET = """
    suid string, binarymod map<string,boolean>, checksum string, cohortid string,
    disabled boolean, exploitid array<string>, externalcampaign string, hostfilemod boolean,
    isdeleted boolean, lastupdatetime timestamp, launchdate string, leids array<string>,
    non_genuine_leids array<string>, serialnumber string, syncedtosophia boolean,
    target_detarget_reason string, target_family string, target_for_patching boolean,
    targeting_process string, inapp_checkout_enabled boolean
"""

LICENSE = """
    serialnumber string, dateadded timestamp, lastchecked timestamp, licensetype int,
    licenseduration bigint, licenseremaining bigint, licensestarttime bigint,
    licensepguid string, snlocale string, snplatform string, sntype string,
    licenseexceptiontype string, licensingleid string, productleid string,
    missingfromlastdata boolean, detectedlicensetype string, hastrialoverride boolean,
    ownerguid string, pguid_anon string
"""

RELATIONSHIP = """
    licenseid string, licenseexpirytimestamp timestamp, appentitlementstatus string,
    activationmode string, billingstatus string, activelicense boolean
"""

PROFILE = f"""
    relationshipprofile array<struct<{RELATIONSHIP}>>, userpguid string,
    usercountrycode string, deviceid string, osuserid string, nglmode string,
    creationtime timestamp, cachelifetime bigint, pguid_anon string
"""

HARDENING = """
    appid string, appexe string, appversion string, msgcreationtimestamp timestamp,
    deviceid string, machineguid string, contextguid string,
    appstate array<struct<statename string, statevalueinfo map<string,string>>>
"""

FILE = """
    name string, signed boolean, failurereason string, version string, checksum string,
    signerinfo string
"""

PRODUCT = f"""
    leid string, locale string, installerid string, files map<string,struct<{FILE}>>,
    lastrulefetched timestamp, firstrulefetched timestamp, licenses array<string>,
    invocationagents map<string,timestamp>, installationtime timestamp, nglapp boolean,
    deploymentmode string, nglprofiles map<string,string>, nglappid string,
    nglappversion string, operatingconfigids array<string>
"""

OPERATING_CONFIG = """
    id string, npd_id string, ngl_app_id string, npd_precedence int, deployment_mode string,
    branding_name string
"""

MACHINES = f"""
    suid string, guid string, machineid string, ngldeviceid string,
    icclientreferenceid string, os string, osversion string, oslocale string,
    gcclientversion string, gcupdaterversion string, lastupdatecheck timestamp,
    firstupdatecheck timestamp, lastrulefetched timestamp, firstrulefetched timestamp,
    lastruleprocessed timestamp, firstruleprocessed timestamp,
    firstdispatchfetched timestamp, lastdispatchfetched timestamp,
    hostfileentries array<string>, country int, region int, city int, ip string,
    domainname string, organizationname string, thorinstalled boolean,
    licenses array<struct<{LICENSE}>>, nglprofiles map<string,struct<{PROFILE}>>,
    producthardeningappinfo array<struct<{HARDENING}>>, leids array<struct<{PRODUCT}>>,
    files array<struct<{FILE}>>, operatingconfigs array<struct<{OPERATING_CONFIG}>>,
    clientuninstalled boolean, clientuninstallreason string, clientuninstalldate timestamp,
    markedforuninstall boolean, clientsource string, lasttimeproductless timestamp,
    uninstallruletype string, invocationagents map<string,timestamp>,
    allocatedgids map<string,string>, ipaddresses array<string>, dnsdomainname string,
    dnshostname string, workgroup string, agsservicestatus string, updatesuppressed boolean,
    lastupdaterequeststatus string, lastupdateattempted timestamp, systemmanufacturer string,
    systemmodel string, ipbelongstoisp boolean, ispname string, homebusinesstype string
"""


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def column_types(ddl: str) -> dict[str, str]:
    """Top-level column names and type texts of a DDL, without needing a session."""
    out, depth, entry = {}, 0, ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = entry.split(None, 1)
            out[name], entry = " ".join(kind.split()), ""
        else:
            entry += ch
    return out
