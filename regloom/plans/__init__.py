"""Driver-side declarations: layouts, target model, mapping rules, compiler."""
