from martwise.sinks.tables import (  # noqa: F401
    create_database_if_not_exists, create_views, execute_query, read_table, replace_table,
    save_as_table, table_info, write_table,
)
