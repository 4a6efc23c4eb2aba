"""Published results the marts and shares must reproduce."""

# Results of the full survey, one row per line, in their order.
ROLE_SHARE = [
    ("Analista de Dados/Data Analyst", 3370, 24.0),
    ("Cientista de Dados/Data Scientist", 2485, 17.7),
    ("Analista de BI/BI Analyst", 1623, 11.6),
    ("Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect", 1368, 9.7),
    ("Engenheiro de Dados/Data Engineer/Data Architect", 1015, 7.2),
    ("Outra Opção", 984, 7.0),
    ("Analista de Negócios/Business Analyst", 715, 5.1),
    ("Analytics Engineer", 641, 4.6),
    ("Desenvolvedor/ Engenheiro de Software/ Analista de Sistemas", 438, 3.1),
    ("Engenheiro de Machine Learning/ML Engineer/AI Engineer", 359, 2.6),
    ("Analista de Suporte/Analista Técnico", 278, 2.0),
    ("Data Product Manager/ Product Manager (PM/APM/DPM/GPM/PO)", 275, 2.0),
    ("Outras Engenharias (não inclui dev)", 117, 0.8),
    ("Professor/Pesquisador", 93, 0.7),
    ("Analista de Inteligência de Mercado/Market Intelligence", 78, 0.6),
]

SENIORITY_BY_EDITION = [
    ("Sênior", "2023_2024", 2838, 36.8),
    ("Pleno", "2023_2024", 2784, 36.1),
    ("Júnior", "2023_2024", 2092, 27.1),
    ("Sênior", "2024_2025", 1573, 41.2),
    ("Pleno", "2024_2025", 1377, 36.1),
    ("Júnior", "2024_2025", 868, 22.7),
    ("Sênior", "2025_2026", 858, 34.3),
    ("Pleno", "2025_2026", 776, 31.0),
    ("Júnior", "2025_2026", 518, 20.7),
    ("Especialista/Staff+", "2025_2026", 349, 14.0),
]

FLEXIBLE = "Modelo híbrido flexível (o funcionário tem liberdade para escolher quando estar no escritório presencialmente)"
FIXED_DAYS = "Modelo híbrido com dias fixos de trabalho presencial"
WORK_MODEL_BY_EDITION = [
    ("Modelo 100% remoto", "2023_2024", 4402, 46.3),
    (FLEXIBLE, "2023_2024", 1944, 20.5),
    ("Modelo 100% presencial", "2023_2024", 1580, 16.6),
    (FIXED_DAYS, "2023_2024", 1580, 16.6),
    ("Modelo 100% remoto", "2024_2025", 2222, 45.7),
    (FLEXIBLE, "2024_2025", 999, 20.5),
    (FIXED_DAYS, "2024_2025", 850, 17.5),
    ("Modelo 100% presencial", "2024_2025", 792, 16.3),
    ("Modelo 100% remoto", "2025_2026", 1282, 39.7),
    ("Modelo 100% presencial", "2025_2026", 670, 20.8),
    (FIXED_DAYS, "2025_2026", 645, 20.0),
    (FLEXIBLE, "2025_2026", 631, 19.5),
]

ROLE_SENIORITY_PAY = [
    ("Engenheiro de Machine Learning/ML Engineer/AI Engineer", "Especialista/Staff+", 28759.67, 27),
    ("Engenheiro de Dados/Data Engineer/Data Architect", "Especialista/Staff+", 22234.31, 62),
    ("Outra Opção", "Especialista/Staff+", 21182.3, 22),
    ("Engenheiro de Machine Learning/ML Engineer/AI Engineer", "Sênior", 20237.8, 158),
    ("Cientista de Dados/Data Scientist", "Especialista/Staff+", 19847.7, 72),
    ("Estatístico", "Sênior", 18469.25, 16),
    ("Analytics Engineer", "Especialista/Staff+", 18313.0, 24),
    ("Engenheiro de Dados/Data Engineer/Data Architect", "Sênior", 17340.92, 492),
    ("Arquiteto de Dados/Data Architect", "Sênior", 16596.24, 47),
    ("Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect", "Sênior", 16365.1, 650),
    ("Analista de BI/BI Analyst", "Especialista/Staff+", 16000.5, 17),
    ("Cientista de Dados/Data Scientist", "Sênior", 15741.75, 1030),
    ("Analista de Negócios/Business Analyst", "Especialista/Staff+", 15306.06, 18),
    ("Desenvolvedor/ Engenheiro de Software/ Analista de Sistemas", "Sênior", 15163.58, 187),
    ("Analista de Dados/Data Analyst", "Especialista/Staff+", 15017.43, 59),
]

LANGUAGE_COUNT_PAY = [
    (0, 5581.38, 785),
    (1, 8354.26, 2414),
    (2, 10019.54, 7981),
    (3, 10481.87, 1799),
    (4, 12456.09, 214),
    (5, 19727.7, 33),
    (None, 17002.64, 4368),
]

GENDER_BY_EDITION = [
    ("2023_2024", "Masculino", 7950, 75.1),
    ("2023_2024", "Feminino", 2586, 24.4),
    ("2023_2024", "Prefiro não informar", 32, 0.3),
    ("2023_2024", "Outro", 18, 0.2),
    ("2024_2025", "Masculino", 3968, 76.1),
    ("2024_2025", "Feminino", 1226, 23.5),
    ("2024_2025", "Prefiro não informar", 15, 0.3),
    ("2024_2025", "Outro", 8, 0.2),
    ("2025_2026", "Masculino", 2707, 77.5),
    ("2025_2026", "Feminino", 768, 22.0),
    ("2025_2026", "Prefiro não informar", 13, 0.4),
    ("2025_2026", "Outro", 7, 0.2),
]

GENDER_SENIORITY_PAY = [
    ("Especialista/Staff+", "Feminino", 17543.35, 70),
    ("Especialista/Staff+", "Masculino", 20618.21, 276),
    ("Júnior", "Feminino", 3818.95, 986),
    ("Júnior", "Masculino", 4068.74, 2476),
    ("Pleno", "Feminino", 7696.55, 1214),
    ("Pleno", "Masculino", 7842.48, 3699),
    ("Sênior", "Feminino", 12417.09, 1127),
    ("Sênior", "Masculino", 14504.38, 4116),
]

AI_PRIORITY = [
    ("Sim, está entre nossas principais prioridades para os próximos 2-4 anos (com discussões de iniciativas e orçamentos de curto a médio prazo).", 993, 28.5, 20814.67),
    ("Não é uma iniciativa que estamos focando e não tem sido uma prioridade.", 745, 21.4, 15662.22),
    ("Sim, é nossa principal prioridade como empresa (com foco executivo significativo e alocação de orçamento relevante).", 610, 17.5, 21930.77),
    ("Mais ou menos... É uma das várias iniciativas que estamos impulsionando, mas não é uma prioridade (iniciativas isoladas e pouco foco).", 550, 15.8, 18842.29),
    ("Mais ou menos... É uma das várias iniciativas que estamos impulsionando, mas não é uma prioridade (tratam-se de iniciativas isoladas e com pouco foco).", 470, 13.5, 18498.34),
    ("Não sei opinar sobre esse assunto.", 121, 3.5, 10529.39),
]

TECHNOLOGY_ADOPTION = [
    ("SQL", 11222),
    ("Python", 10514),
    ("R", 1496),
    ("VB/VBA", 786),
    ("Scala", 458),
    ("C/C++/C#", 235),
    ("Rust", 61),
    ("Julia", 40),
]

REGION_PAY = [
    ("Sudeste", 11939.16, 10745),
    ("Centro-oeste", 10769.31, 1129),
    ("Sul", 10234.52, 3271),
    ("Nordeste", 8902.34, 1778),
    ("Norte", 8831.65, 231),
]

SECTOR_SHARE = [
    ("Finanças ou Bancos", 3487, 19.8),
    ("Tecnologia/Fábrica de Software", 3219, 18.3),
    ("Área de Consultoria", 1417, 8.1),
    ("Varejo", 1345, 7.6),
    ("Outra Opção", 1263, 7.2),
    ("Indústria", 1192, 6.8),
    ("Educação", 775, 4.4),
    ("Área da Saúde", 725, 4.1),
    ("Setor Público", 626, 3.6),
    ("Internet/Ecommerce", 516, 2.9),
]

COMPANY_SIZE_PAY = [
    ("Acima de 3.000", 12320.93, 7808),
    ("de 1.001 a 3.000", 11645.71, 1966),
    ("de 501 a 1.000", 11269.28, 1676),
    ("de 51 a 100", 10648.74, 1231),
    ("de 101 a 500", 10533.44, 2944),
    ("de 11 a 50", 10070.09, 1214),
    ("de 6 a 10", 8990.43, 299),
    ("de 1 a 5", 8633.13, 456),
]

SENIORITY_EDITION_PAY = [
    ("Especialista/Staff+", "2025_2026", 20029.12, 349),
    ("Júnior", "2023_2024", 3909.67, 2092),
    ("Júnior", "2024_2025", 4157.74, 868),
    ("Júnior", "2025_2026", 4152.99, 518),
    ("Pleno", "2023_2024", 7539.65, 2784),
    ("Pleno", "2024_2025", 8047.7, 1377),
    ("Pleno", "2025_2026", 8301.4, 776),
    ("Sênior", "2023_2024", 13669.27, 2838),
    ("Sênior", "2024_2025", 14604.43, 1573),
    ("Sênior", "2025_2026", 14470.18, 858),
]

ETHNICITY_BY_EDITION = [
    ("2023_2024", "Branca", 6828, 64.5),
    ("2023_2024", "Parda", 2562, 24.2),
    ("2023_2024", "Preta", 774, 7.3),
    ("2023_2024", "Amarela", 294, 2.8),
    ("2023_2024", "Prefiro não informar", 68, 0.6),
    ("2023_2024", "Outra", 36, 0.3),
    ("2023_2024", "Indígena", 24, 0.2),
    ("2024_2025", "Branca", 3478, 66.7),
    ("2024_2025", "Parda", 1180, 22.6),
    ("2024_2025", "Preta", 352, 6.7),
    ("2024_2025", "Amarela", 155, 3.0),
    ("2024_2025", "Prefiro não informar", 37, 0.7),
    ("2024_2025", "Indígena", 10, 0.2),
    ("2024_2025", "Outra", 5, 0.1),
    ("2025_2026", "Branca", 2273, 65.1),
    ("2025_2026", "Parda", 842, 24.1),
    ("2025_2026", "Preta", 217, 6.2),
    ("2025_2026", "Amarela", 117, 3.3),
    ("2025_2026", "Prefiro não informar", 28, 0.8),
    ("2025_2026", "Outra", 12, 0.3),
    ("2025_2026", "Indígena", 4, 0.1),
]

ETHNICITY_SENIORITY_PAY = [
    ("Especialista/Staff+", "Branca", 20498.41, 244),
    ("Especialista/Staff+", "Preta", 19913.52, 23),
    ("Especialista/Staff+", "Parda", 18298.99, 67),
    ("Júnior", "Prefiro não informar", 5855.32, 31),
    ("Júnior", "Amarela", 4701.53, 97),
    ("Júnior", "Branca", 4048.69, 2116),
    ("Júnior", "Parda", 3913.23, 934),
    ("Júnior", "Preta", 3640.84, 285),
    ("Pleno", "Prefiro não informar", 9611.61, 18),
    ("Pleno", "Amarela", 9071.92, 133),
    ("Pleno", "Branca", 7895.45, 3151),
    ("Pleno", "Parda", 7669.93, 1266),
    ("Pleno", "Preta", 6850.36, 353),
    ("Sênior", "Prefiro não informar", 20307.27, 44),
    ("Sênior", "Amarela", 14478.21, 157),
    ("Sênior", "Branca", 14330.16, 3555),
    ("Sênior", "Parda", 13404.19, 1163),
    ("Sênior", "Preta", 12485.11, 325),
]

GOLD = {
    "role_share": ROLE_SHARE,
    "seniority_by_edition": SENIORITY_BY_EDITION,
    "work_model_by_edition": WORK_MODEL_BY_EDITION,
    "role_seniority_pay": ROLE_SENIORITY_PAY,
    "language_count_pay": LANGUAGE_COUNT_PAY,
    "gender_by_edition": GENDER_BY_EDITION,
    "gender_seniority_pay": GENDER_SENIORITY_PAY,
    "ai_priority": AI_PRIORITY,
    "technology_adoption": TECHNOLOGY_ADOPTION,
    "region_pay": REGION_PAY,
    "sector_share": SECTOR_SHARE,
    "company_size_pay": COMPANY_SIZE_PAY,
    "seniority_edition_pay": SENIORITY_EDITION_PAY,
    "ethnicity_by_edition": ETHNICITY_BY_EDITION,
    "ethnicity_seniority_pay": ETHNICITY_SENIORITY_PAY,
}
