"""Document schemas of the nine collections.

Ports and booleans are read as text and cast later: a document may hold 22,
"22" or 22.0 for the same port, and only a text field accepts all three. Lists are
read as the text of their JSON and taken apart later.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
PARTIAL_COLUMN = "_partial_document"
# The list of a document's own documents where a reader parsed it already.
PARSED_LIST = "_parsed_list"

_RANGE = "struct<min:string,max:string>"
_CAMEL_PORTS = f"struct<destinationPortRange:{_RANGE}>"
_SNAKE_PORTS = f"struct<destination_port_range:{_RANGE}>"
# Elements of lists are parsed one by one, so that a bad one costs only itself.
ROUTE_RULE = f"networkEntityId string, {CORRUPT_COLUMN} string"
INGRESS_RULE = f"""source string, protocol string, tcpOptions {_CAMEL_PORTS}, udpOptions {_CAMEL_PORTS},
    {CORRUPT_COLUMN} string"""
_DESCRIBED = (
    "display_name string, compartment_id string, lifecycle_state string, time_created string"
)

_DDL = {
    "routes": """
        identifier string,
        additional_details struct<routeRules:string>""",
    "subnets": """
        identifier string, display_name string,
        additional_details struct<routeTableId:string,prohibitPublicIpOnVnic:string,
            securityListIds:string,vcnId:string,subnetDomainName:string>""",
    "securitylists": f"""
        identifier string, {_DESCRIBED},
        additional_details struct<vcnId:string,ingressSecurityRules:string>""",
    "vnics": """
        identifier string, display_name string,
        additional_details struct<subnetId:string,privateIp:string,publicIp:string>""",
    "nsgdata": f"""
        identifier string, id string, {_DESCRIBED},
        additional_details struct<vcnId:string>""",
    "nsgrules": f"""
        `nsg-id` string, region string, id string, direction string, source string, protocol string,
        tcp_options {_SNAKE_PORTS}, udp_options {_SNAKE_PORTS}""",
    "nsgvnic": "`nsg-id` string, vnic_id string, region string",
    "privateips": """
        id string, identifier string, vnic_id string, `vnic-id` string, vnicId string,
        ip_address string, ipAddress string, region string, `subnet-id` string""",
    "publicips": """
        id string, ip_address string, ipAddress string,
        private_ip_id string, privateIpId string, region string""",
}


def document_schema(collection: str) -> T.StructType:
    """Schema of one document of ``collection``."""
    return T.StructType.fromDDL(_DDL[collection])


def reading_schema(collection: str) -> T.StructType:
    """Document schema plus the column that receives unreadable lines."""
    return document_schema(collection).add(CORRUPT_COLUMN, T.StringType())
