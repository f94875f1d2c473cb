"""Fixed values.

Everything here must equal the values the exposure reports are defined with;
none of it is tunable.
"""

# The nine collections; also the base names of their JSON-lines files.
COLLECTIONS = (
    "nsgdata",
    "nsgrules",
    "nsgvnic",
    "securitylists",
    "publicips",
    "privateips",
    "subnets",
    "vnics",
    "routes",
)

# A route target whose id contains this text is an internet gateway.
INTERNET_GATEWAY_MARKER = "internetgateway"

# Rule fields.
ANY_SOURCE = "0.0.0.0/0"
INGRESS = "INGRESS"
PROTOCOL_ALL = "all"
PROTOCOL_TCP = "6"
PROTOCOL_UDP = "17"
SSH_PORT = 22
RDP_PORT = 3389

# Labels that appear in results.
CASE_ALL = "ALL"
CASE_SSH = "22"
CASE_RDP = "3389"
CASE_NONE = "NONE"
FLAG_INSECURE = "INSECURE"
CASE_SEPARATOR = ", "
ALL_PORTS = "ALL_PORTS"
SOURCE_SL = "SECURITY_LIST"
SOURCE_NSG = "NSG"

# The network label is the last label before this domain suffix.
VCN_NAME_PATTERN = r"\.([^.]+)\.oraclevcn\.com$"
