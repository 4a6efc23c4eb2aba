"""Answer vocabularies: band midpoints, truth labels, label folds and display orders."""

# Salary band -> midpoint, two misspelt bands included.
SALARY_MIDPOINTS: dict[str, float] = {
    "Menos de R$ 1.000/mês": 500.0,
    "de R$ 101/mês a R$ 2.000/mês": 1500.5,
    "de R$ 1.001/mês a R$ 2.000/mês": 1500.5,
    "de R$ 2.001/mês a R$ 3.000/mês": 2500.5,
    "de R$ 3.001/mês a R$ 4.000/mês": 3500.5,
    "de R$ 4.001/mês a R$ 6.000/mês": 5000.5,
    "de R$ 6.001/mês a R$ 8.000/mês": 7000.5,
    "de R$ 8.001/mês a R$ 12.000/mês": 10000.5,
    "de R$ 12.001/mês a R$ 16.000/mês": 14000.5,
    "de R$ 16.001/mês a R$ 20.000/mês": 18000.5,
    "de R$ 20.001/mês a R$ 25.000/mês": 22500.5,
    "de R$ 25.001/mês a R$ 30.000/mês": 27500.5,
    "de R$ 25.001/mês a R$ 3000/mês": 27500.5,
    "de R$ 30.001/mês a R$ 40.000/mês": 35000.5,
    "Acima de R$ 40.001/mês": 45000.0,
}

# Spellings of a yes/no answer.
TRUTH_LABELS: dict[str, tuple[str, ...]] = {
    "Sim": ("1", "TRUE", "true"),
    "Nao": ("0", "FALSE", "false"),
}

# Technology label -> flag column, and the flags that count as languages.
TECHNOLOGY_FLAGS: dict[str, str] = {
    "SQL": "lang_sql",
    "Python": "lang_python",
    "R": "lang_r",
    "C/C++/C#": "lang_c_cpp_csharp",
    "Scala": "lang_scala",
    "Julia": "lang_julia",
    "VB/VBA": "lang_vb_vba",
    "Rust": "lang_rust",
}
LANGUAGE_FLAGS = tuple(TECHNOLOGY_FLAGS.values())

# Display orders.
SENIORITY_ORDER = ("Júnior", "Pleno", "Sênior", "Especialista/Staff+")
GENDER_ORDER = ("Masculino", "Feminino", "Outro", "Prefiro não informar")
GAP_BASE, GAP_OTHER = "Masculino", "Feminino"

# Answer texts folded onto one label.
ROLE_FOLD: dict[str, str] = {
    "Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect": "Engenheiro de Dados/Data Engineer/Data Architect",
}
WORK_MODEL_FOLD: dict[str, str] = {
    "Trabalho presencial": "100% presencial",
    "Modelo 100% presencial": "100% presencial",
    "Trabalho remoto": "100% remoto",
    "Modelo 100% remoto": "100% remoto",
}
AI_PRIORITY_FOLD: dict[str, str] = {
    "Sim, está entre nossas principais prioridades para os próximos 2-4 anos (com discussões de iniciativas e orçamentos de curto a médio prazo).": "Prioridade alta (2-4 anos)",
    "Sim, é nossa principal prioridade como empresa (com foco executivo significativo e alocação de orçamento relevante).": "Principal prioridade estratégica",
    "Não é uma iniciativa que estamos focando e não tem sido uma prioridade.": "Não é prioridade / Sem foco",
    "Mais ou menos... É uma das várias iniciativas que estamos impulsionando, mas não é uma prioridade (tratam-se de iniciativas isoladas e com pouco foco).": "Iniciativa isolada (Baixa prioridade)",
    "Mais ou menos... É uma das várias iniciativas que estamos impulsionando, mas não é uma prioridade (iniciativas isoladas e pouco foco).": "Iniciativa isolada (Baixa prioridade)",
    "Não sei opinar sobre esse assunto.": "Não sabe / Não opinou",
}
