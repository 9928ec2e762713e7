"""Column expressions: text, address components, geodesy and OSM scalars."""
