"""The tables and reports themselves, composed from functions and operators."""
