"""Row operators: casts and checks, duplicate marking, routing, check log, reports."""
