"""Training-data operators: mixing, licences, packing, search, chat, language, dedup."""
