"""Fixed values of the road data model: they must equal the published ones for right results."""

#: Road kinds kept by the extraction.
ROAD_KINDS = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "service", "motorway_link",
    "trunk_link", "primary_link", "secondary_link", "tertiary_link", "living_street", "track", "road",
)

#: Kinds of the wider road network (with paths and busways).
NETWORK_KINDS = (
    "motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary",
    "tertiary_link", "residential", "living_street", "unclassified", "service", "pedestrian", "busway", "track", "path",
    "footway", "cycleway", "bridleway", "road",
)

PAVED = (
    "paved", "asphalt", "concrete", "concrete:plates", "concrete:lanes", "paving_stones", "sett", "unhewn_cobblestone",
    "cobblestone", "cobblestone:flattened", "metal", "wood", "tartan", "artificial_turf",
)
UNPAVED = (
    "unpaved", "compacted", "fine_gravel", "gravel", "shells", "rock", "pebblestone", "ground", "dirt", "earth", "grass",
    "grass_paver", "mud", "sand", "woodchips", "snow", "ice", "salt", "clay", "caliche", "laterite",
)
INFERRED_PAVED = (
    "motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary",
    "tertiary_link", "residential", "living_street", "unclassified", "service", "pedestrian", "busway",
)
INFERRED_UNPAVED = ("track", "path", "footway", "bridleway", "cycleway")

HIGHWAY_CLASS = {
    "motorway": "motorway", "motorway_link": "motorway", "trunk": "trunk", "trunk_link": "trunk", "primary": "primary",
    "primary_link": "primary", "secondary": "secondary", "secondary_link": "secondary", "tertiary": "tertiary",
    "tertiary_link": "tertiary", "residential": "residential", "living_street": "residential", "unclassified": "unclassified",
    "road": "unclassified", "service": "service", "busway": "service", "pedestrian": "pedestrian", "track": "track",
    "path": "path", "footway": "path", "cycleway": "path", "bridleway": "path",
}

#: Countries cut back to their own boundary: two-letter to three-letter code.
CLIPPED = {
    "AE": "ARE", "BH": "BHR", "KW": "KWT", "OM": "OMN", "QA": "QAT", "SA": "SAU", "MY": "MYS", "SG": "SGP", "BN": "BRN", "HT": "HTI",
    "DO": "DOM", "IL": "ISR", "PS": "PSE", "SN": "SEN", "GM": "GMB", "AS": "ASM", "GU": "GUM", "MP": "MNP", "IE": "IRL", "ID": "IDN",
}

OBSOLETE_CODES = ("AN", "CS")
PRIORITY_KINDS = ("primary", "secondary", "tertiary")
EMPTY_CODES = ("", "-99", "-1", "NA", "N/A", "NULL", "NONE", "NAN")

MPH, KNOT = 1.60934, 1.852
ROWS_PER_PART, TARGET_ROWS = 200_000, 195_000
BUFFER_DEG = 0.002
EQUATOR_M, FLATTENING = 6378137.0, 1 / 298.257223563
