from cardwarden.functions.sqlfunctions import register_sql_functions

__all__ = ["register_sql_functions"]
