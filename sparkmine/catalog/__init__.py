"""The registered queries and, for each, the SQL that gives the same rows."""
