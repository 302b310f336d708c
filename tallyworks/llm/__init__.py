"""Operations of a training-data pipeline: archives, chat formats, language, overlap, extraction, dedup, mixing, scoring, rules."""
