SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, q_n int"
