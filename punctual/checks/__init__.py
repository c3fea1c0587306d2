"""The registered queries, the feeds they run on and the SQL they are checked against."""
