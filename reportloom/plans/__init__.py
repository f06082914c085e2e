"""Queries over the tables of a data directory, with SQL that states each anew."""
