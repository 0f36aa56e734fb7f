"""The registered queries and, apart from them, the SQL they are compared with."""
