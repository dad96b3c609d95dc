"""Field numbers of the binary page format."""

# --- Fixed values: field numbers of the public feature-collection schema. ---
# FeatureCollectionPBuffer
FC_QUERY_RESULT = 2
# QueryResult
QR_FEATURE_RESULT = 1
# FeatureResult
FR_GEOMETRY_TYPE = 7
FR_SPATIAL_REFERENCE = 8
FR_EXCEEDED = 9
FR_HAS_Z = 10
FR_HAS_M = 11
FR_TRANSFORM = 12
FR_FIELDS = 13
FR_FEATURES = 15
# Field
FIELD_NAME = 1
# SpatialReference
SR_WKID = 1
SR_LATEST_WKID = 2
# Transform / Scale / Translate
TF_ORIGIN = 1
TF_SCALE = 2
TF_TRANSLATE = 3
XY_X = 1
XY_Y = 2
# Feature
FEAT_ATTRIBUTES = 1
FEAT_GEOMETRY = 2
FEAT_SHAPE_BUFFER = 3
FEAT_CURVE_GEOMETRY = 7
# Geometry
GEOM_TYPE = 1
GEOM_LENGTHS = 2
GEOM_COORDS = 3
# Value: one of these slots, plus an optional field index
VALUE_STRING = 1
VALUE_FLOAT = 2
VALUE_DOUBLE = 3
VALUE_SINT32 = 4
VALUE_UINT32 = 5
VALUE_INT64 = 6
VALUE_UINT64 = 7
VALUE_SINT64 = 8
VALUE_BOOL = 9
VALUE_NULL = 10
VALUE_INDEX = 11
# -----------------------------------------------------------------------------
