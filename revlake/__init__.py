"""revlake: point-in-time analytics for published figures that are later revised, on Spark DataFrames."""

from revlake.current import from_current_store, from_vintage, read, update
from revlake.registry import all_symbols, by_asset_class, load as load_registry, symbol
from revlake.store import Store, load_manifest, require_schema, schema_version
from revlake.vintage import Vintage

__all__ = ["Store", "Vintage", "all_symbols", "by_asset_class", "from_current_store", "from_vintage", "load_manifest", "load_registry", "read", "require_schema", "schema_version", "symbol", "update"]
