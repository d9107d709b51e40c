from . import csv, layout, schemas, tables

__all__ = ["csv", "layout", "schemas", "tables"]
