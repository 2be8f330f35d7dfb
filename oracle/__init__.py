"""DuckDB SQL that states each query a second time, over the same test tables."""
