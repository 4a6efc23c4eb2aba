"""Which raw column of each survey edition feeds which unified column.

Editions drift: one uses tuple-style headers, question letters shift and option
numbers move. The drift is resolved by this explicit table only, never by
guessing from similar names.
"""

EDITION_COLUMN = "ano_pesquisa"

# Raw column names per edition, in the order of the unified table.
RAW_COLUMNS: dict[str, dict[str, str]] = {
    "2023_2024": {
        "id_respondente": "_'p0'__'id'_#0",
        "idade": "_'p1_a_'__'idade'_#1",
        "faixa_idade": "_'p1_a_1_'__'faixa_idade'_#2",
        "genero": "_'p1_b_'__'genero'_#3",
        "cor_raca_etnia": "_'p1_c_'__'cor/raca/etnia'_#4",
        "pcd": "_'p1_d_'__'pcd'_#5",
        "uf_onde_mora": "_'p1_i_1_'__'uf_onde_mora'_#23",
        "regiao_onde_mora": "_'p1_i_2_'__'regiao_onde_mora'_#24",
        "nivel_ensino": "_'p1_l_'__'nivel_de_ensino'_#27",
        "area_formacao": "_'p1_m_'__'área_de_formação'_#28",
        "situacao_trabalho": "_'p2_a_'__'qual_sua_situação_atual_de_trabalho?'_#29",
        "setor": "_'p2_b_'__'setor'_#30",
        "numero_funcionarios": "_'p2_c_'__'numero_de_funcionarios'_#31",
        "cargo_atual": "_'p2_f_'__'cargo_atual'_#34",
        "senioridade": "_'p2_g_'__'nivel'_#35",
        "faixa_salarial": "_'p2_h_'__'faixa_salarial'_#36",
        "modelo_trabalho_atual": "_'p2_r_'__'atualmente_qual_a_sua_forma_de_trabalho?'_#62",
        "modelo_trabalho_ideal": "_'p2_s_'__'qual_a_forma_de_trabalho_ideal_para_você?'_#63",
        "numero_pessoas_dados_empresa": "_'p3_a_'__'qual_o_número_aproximado_de_pessoas_que_atuam_com_dados_na_sua_empresa_hoje?'_#65",
        "ia_prioridade_empresa": "_'p3_e_'__'ai_generativa_é_uma_prioridade_em_sua_empresa?'_#103",
        "usa_chatgpt_llm": "_'p4_m_'__'utiliza_chatgpt_ou_llms_no_trabalho?'_#238",
        "cloud_preferida": "_'p4_i_'__'cloud_preferida'_#203",
        "ferramenta_bi_preferida": "_'p4_k_'__'qual_sua_ferramenta_de_bi_preferida?'_#228",
        "lang_sql": "_'p4_d_1_'__'sql'_#144",
        "lang_r": "_'p4_d_2_'__'r_'_#145",
        "lang_python": "_'p4_d_3_'__'python'_#146",
        "lang_c_cpp_csharp": "_'p4_d_4_'__'c/c++/c#'_#147",
        "lang_julia": "_'p4_d_7_'__'julia'_#150",
        "lang_vb_vba": "_'p4_d_9_'__'visual_basic/vba'_#152",
        "lang_scala": "_'p4_d_10_'__'scala'_#153",
        "lang_rust": "_'p4_d_12_'__'rust'_#155",
        "satisfeito_empresa": "_'p2_k_'__'você_está_satisfeito_na_sua_empresa_atual?'_#39",
        "motivo_insatisfacao": "_'p2_l_'__'qual_o_principal_motivo_da_sua_insatisfação_com_a_empresa_atual?'_#40",
        "planos_de_mudar_de_emprego_6m": "_'p2_n_'__'você_pretende_mudar_de_emprego_nos_próximos_6_meses?'_#49",
    },
    "2024_2025": {
        "id_respondente": "0.a_token",
        "idade": "1.a_idade",
        "faixa_idade": "1.a.1_faixa_idade",
        "genero": "1.b_genero",
        "cor_raca_etnia": "1.c_cor/raca/etnia",
        "pcd": "1.d_pcd",
        "uf_onde_mora": "1.i.1_uf_onde_mora",
        "regiao_onde_mora": "1.i.2_regiao_onde_mora",
        "nivel_ensino": "1.l_nivel_de_ensino",
        "area_formacao": "1.m_área_de_formação",
        "situacao_trabalho": "2.a_situação_de_trabalho",
        "setor": "2.b_setor",
        "numero_funcionarios": "2.c_numero_de_funcionarios",
        "cargo_atual": "2.f_cargo_atual",
        "senioridade": "2.g_nivel",
        "faixa_salarial": "2.h_faixa_salarial",
        "modelo_trabalho_atual": "2.r_modelo_de_trabalho_atual",
        "modelo_trabalho_ideal": "2.s_modelo_de_trabalho_ideal",
        "numero_pessoas_dados_empresa": "3.a_numero_de_pessoas_em_dados",
        "ia_prioridade_empresa": "3.e_ai_generativa_e_llm_é_uma_prioridade?",
        "usa_chatgpt_llm": "4.m_usa_chatgpt_ou_copilot_no_trabalho?",
        "cloud_preferida": "4.i_cloud_preferida",
        "ferramenta_bi_preferida": "4.k_ferramenta_de_bi_preferida",
        "lang_sql": "4.d.1_sql",
        "lang_r": "4.d.2_r",
        "lang_python": "4.d.3_python",
        "lang_c_cpp_csharp": "4.d.4_c/c++/c#",
        "lang_julia": "4.d.7_julia",
        "lang_vb_vba": "4.d.9_visual_basic/vba#90",
        "lang_scala": "4.d.10_scala",
        "lang_rust": "4.d.12_rust",
        "satisfeito_empresa": "2.k_satisfeito_atualmente",
        "motivo_insatisfacao": "2.l_motivo_insatisfacao",
        "planos_de_mudar_de_emprego_6m": "2.n_planos_de_mudar_de_emprego_6m",
    },
    "2025_2026": {
        "id_respondente": "0.a_token",
        "idade": "1.a_idade",
        "faixa_idade": "1.a.1_faixa_idade",
        "genero": "1.b_genero",
        "cor_raca_etnia": "1.c_cor/raca/etnia",
        "pcd": "1.d_pcd",
        "uf_onde_mora": "1.i.1_uf_onde_mora",
        "regiao_onde_mora": "1.i.2_regiao_onde_mora",
        "nivel_ensino": "1.l_nivel_de_ensino",
        "area_formacao": "1.m_área_de_formação",
        "situacao_trabalho": "2.a_situação_de_trabalho",
        "setor": "2.b_setor",
        "numero_funcionarios": "2.c_numero_de_funcionarios",
        "cargo_atual": "2.f_cargo_atual",
        "senioridade": "2.g_nivel",
        "faixa_salarial": "2.h_faixa_salarial",
        "modelo_trabalho_atual": "2.q_modelo_de_trabalho_atual",
        "modelo_trabalho_ideal": "2.r_modelo_de_trabalho_ideal",
        "numero_pessoas_dados_empresa": "3.a_numero_de_pessoas_em_dados",
        "ia_prioridade_empresa": "3.e_ai_generativa_e_llm_é_uma_prioridade?",
        "usa_chatgpt_llm": "4.j_usa_chatgpt_ou_copilot_no_trabalho?",
        "cloud_preferida": "4.f_cloud_preferida",
        "ferramenta_bi_preferida": "4.h_ferramenta_de_bi_preferida",
        "lang_sql": "4.c.1_sql",
        "lang_r": "4.c.2_r",
        "lang_python": "4.c.3_python",
        "lang_c_cpp_csharp": "4.c.4_c/c++/c#",
        "lang_julia": "4.c.5_julia",
        "lang_vb_vba": "4.c.6_visual_basic/vba#86",
        "lang_scala": "4.c.7_scala",
        "lang_rust": "4.c.9_rust",
        "satisfeito_empresa": "2.k_satisfeito_atualmente",
        "motivo_insatisfacao": "2.l_motivo_insatisfacao",
        "planos_de_mudar_de_emprego_6m": "2.n_planos_de_mudar_de_emprego_6m",
    },
}

EDITIONS = tuple(RAW_COLUMNS)

# The unified column order.
SILVER_COLUMNS = (
    "id_respondente",
    "idade",
    "faixa_idade",
    "genero",
    "cor_raca_etnia",
    "pcd",
    "uf_onde_mora",
    "regiao_onde_mora",
    "nivel_ensino",
    "area_formacao",
    "situacao_trabalho",
    "setor",
    "numero_funcionarios",
    "cargo_atual",
    "senioridade",
    "faixa_salarial",
    "faixa_salarial_media",
    "modelo_trabalho_atual",
    "modelo_trabalho_ideal",
    "numero_pessoas_dados_empresa",
    "ia_prioridade_empresa",
    "usa_chatgpt_llm",
    "cloud_preferida",
    "ferramenta_bi_preferida",
    "lang_sql",
    "lang_r",
    "lang_python",
    "lang_c_cpp_csharp",
    "lang_julia",
    "lang_vb_vba",
    "lang_scala",
    "lang_rust",
    "satisfeito_empresa",
    "motivo_insatisfacao",
    "planos_de_mudar_de_emprego_6m",
    "ano_pesquisa",
)
