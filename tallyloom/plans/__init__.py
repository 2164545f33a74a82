"""Jobs composed of operators: cleaning submissions, analysis sets, briefing tables."""
