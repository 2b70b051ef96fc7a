"""Every operator applied to the driver tables, with the equivalent DuckDB SQL where one exists."""
