"""The registered queries and the SQL a second engine checks them with."""
