"""Training-data operators: tokenising, personal data, search, quality rules,
de-duplication, sharding, mixing and license scans. Nothing else in the library
imports this subpackage; its queries are registered from ``catalog``."""
