"""Readers and writers for feature collections, OSM dumps, tables and entity documents."""
