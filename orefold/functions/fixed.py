"""Names, labels and rates that results must carry exactly."""

from __future__ import annotations

# Labels for missing text.
UNKNOWN_COUNTRY = "Desconocido"
UNCATEGORISED = "Sin categoría"

# Multiplier to US dollars; any other currency counts as dollars.
USD_RATES = {"MXN": 0.058, "COP": 0.00024, "PEN": 0.27}

# The four entities, in load order.
ENTITIES = ("enrollments", "courses", "progress", "instructors")

# Gold table names.
GOLD_COMPLETION = "gold_completion_rate"
GOLD_REVENUE = "gold_revenue_instructor"
GOLD_LOW_ENGAGEMENT = "gold_cursos_abandonados"
GOLD_CATEGORIES = "gold_top_categorias"

# Quality rule names.
RULE_PAYMENT = "pago_valido"
RULE_ENROLLMENT_COURSE = "course_id_no_nulo"
RULE_COURSE_KEY = "course_id_existe"
RULE_LESSONS = "total_lessons_valido"
