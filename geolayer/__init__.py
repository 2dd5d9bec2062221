"""Queries on geospatial feature layers held as Spark tables."""

from geolayer.functions.crs import match_crs, validate_crs
from geolayer.functions.nested import traverse_json
from geolayer.layer import LayerInfo
from geolayer.operators.requests import with_request_key
from geolayer.operators.select import (
    features_by_box,
    features_by_filter,
    features_by_geom,
    features_by_id,
    ids_by_field,
    ids_by_geom,
    ids_by_sql,
)
from geolayer.operators.retrieve import get_features
from geolayer.session import get_session
from geolayer.sources.layers import read_layer, write_layer

__all__ = [
    "LayerInfo", "features_by_box", "features_by_filter", "features_by_geom", "features_by_id",
    "get_features", "get_session", "ids_by_field", "ids_by_geom", "ids_by_sql", "match_crs",
    "read_layer", "traverse_json", "validate_crs", "with_request_key", "write_layer",
]
