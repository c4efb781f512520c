"""The models, from raw tables to marts."""
