"""Whole stages: crawl, scrape, summarise, translate, speech and the pipeline."""
