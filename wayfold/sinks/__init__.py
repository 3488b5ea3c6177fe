"""Writers: tiles, wire formats, GeoJSON."""
