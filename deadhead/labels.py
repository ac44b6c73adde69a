"""Labels that occur as values in the input and output tables.

Fixed values: results are only comparable when these read exactly as they do here.
"""

# Leg kinds, one per pair of facility kinds.
STORE_TO_DC = "SO"
DC_TO_STORE = "OS"
STORE_TO_PARTNER = "SSRS1"
DC_TO_PARTNER = "OSRS1"
PARTNER_TO_DC = "SRS2O"
PARTNER_LANE = "SRS1-SRS2"

# Partner facilities.
PARTNER_MARK = "SRS"
PARTNER_ID_PREFIX = "SRS_"
PARTNER_ORIGIN_TYPE = "SRS1"
PARTNER_DEST_TYPE = "SRS2"
PARTNER_CARRIER = "BSL"

# Which side a leg belongs to.
SIDE_PARTNER = "SRS"
SIDE_NETWORK = "THD"

# Facility types.
STORE_TYPE = "STR"
DC_TYPES = ("BDC", "FDC", "FDC/BDC", "BDC/FDC")
EMPTY_TYPE_PAIRS = ("STR-BDC", "STR-FDC", "STR-FDC/BDC")

# Modes.
TOUR_MODE = "D"
ONE_WAY = "OW"
DEDICATED = "DED"

MISSING_DISTANCES = "MISSING DISTANCES"
