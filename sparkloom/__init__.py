"""sparkloom: question-answer dataset building and corpus preparation as Spark plans."""
